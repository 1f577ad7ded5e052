"""Streaming and batch inputs."""

"""Column expressions; none of them needs a Python worker."""

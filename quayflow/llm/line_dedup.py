"""Drop lines that very many documents share, in all but one of them.

A line's key is the line without ASCII white space around it, A-Z in lower case. Texts stay
where they are, in stored blocks; a block sends one row for each of its documents' distinct
long keys: the key's 128-bit hash, the document and the line where the key first occurs.
These rows are range-partitioned by hash and sorted by hash, document (the largest first)
and position, and each partition is streamed: the first document of a hash keeps its lines,
those of the others go once enough documents are seen.

Ranges are cut within a hash too, so that a line of very many documents fills several
partitions. Only the first and the last hash of a partition can go on in another one; their
rows are put aside with the partition's largest documents for the hash, and a table of two
hashes for each partition settles them. The verdicts go back to the blocks, which return a
compressed bitmap of kept lines for each document in place of a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, stored, stored_by, texts
from quayflow.llm.token_counts import bucket_count

BLOCK = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
LEAST_LENGTH = 40
LEAST_DOCS = 5
RANGE_ROWS = 1 << 20  # rows for each partition of sorted keys
LEAST_RANGES = 8
FEW_BORDERS = 1 << 18  # verdicts that are broadcast, at most; some 40 bytes each
LINE = "high bigint, low bigint, doc_id bigint, block bigint, line int"
DROP, OPEN, BORDER = 0, 1, 2
FOUND = f"kind int, {LINE}"


# --- blocks


class _Lines:
    """The lines of a block's texts, and the first line of each long key of a document."""

    def __init__(self, values: pa.Array, least_length: int):
        lists = pc.split_pattern(values, "\n")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.ends = offsets - offsets[0]
        lines = lists.values.slice(int(offsets[0]), int(self.ends[-1]))
        keys = pc.ascii_lower(pc.ascii_trim(lines, characters=BLANKS))
        self.long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), least_length).to_numpy(False))
        coded = keys.take(pa.array(self.long)).dictionary_encode()
        self.keys, code = coded.dictionary, coded.indices.to_numpy(False).astype(np.int64)
        row = np.searchsorted(self.ends, self.long, "right") - 1
        pair = row * max(1, len(self.keys)) + code
        _, first, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        self.first, self.row, self.code = self.long[first], row[first], code[first]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each of the pairs' keys, as two signed numbers."""
        raw = b"".join(xxhash.xxh3_128_digest(key) for key in self.keys.to_pylist())
        both = np.frombuffer(raw, ">i8").reshape(-1, 2).astype(np.int64)[self.code]
        return both[:, 0], both[:, 1]

    def kept(self, dropped_first: np.ndarray) -> np.ndarray:
        """Which lines stay if the keys that first occur at these lines lose all of theirs."""
        stay = np.ones(int(self.ends[-1]), bool)
        stay[self.long] = ~np.isin(self.first, dropped_first)[self.pair]
        return stay


def _store(batches: Iterator[pa.RecordBatch]):
    for number, table in enumerate(blocks(batches, size=BLOCK)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table.combine_chunks())
        block = (TaskContext.get().partitionId() << 32) + number
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            names=["block", "content"],
        )


def _load(content: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(content.as_py()).read_all()


def _send(least_length: int):
    def send(batches):
        for batch in batches:
            for block, content in zip(batch.column("block"), batch.column("content"), strict=True):
                table = _load(content)
                lines = _Lines(texts(table), least_length)
                high, low = lines.hashes()
                ids = column(table, "doc_id").take(pa.array(lines.row))
                whole = pa.RecordBatch.from_arrays(
                    [
                        pa.array(high),
                        pa.array(low),
                        ids,
                        pa.array(np.full(len(high), block.as_py(), np.int64)),
                        pa.array(lines.first.astype(np.int32)),
                    ],
                    names=["high", "low", "doc_id", "block", "line"],
                )
                for at in range(0, whole.num_rows, 1 << 16):
                    yield whole.slice(at, 1 << 16)

    return send


# --- sorted keys


class _Stream:
    """Runs of equal hashes in sorted rows that come in batches.

    Ranks number a hash's documents in the order they come. Rows of later documents than the
    first are held until the run has ``least_docs`` of them or ends.
    """

    def __init__(self, least_docs: int):
        self.least = least_docs
        self.key: tuple[int, int] | None = None
        self.doc: tuple | None = None
        self.rank = 0
        self.is_first_run = True
        self.top: list = []
        self.held: list[tuple[np.ndarray, ...]] = []

    def _emit(self, kind: int, high, low, ids, null, block, line):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(high), kind, np.int32)),
                pa.array(high),
                pa.array(low),
                pa.array(ids, pa.int64(), mask=null),
                pa.array(block),
                pa.array(line),
            ],
            names=["kind", "high", "low", "doc_id", "block", "line"],
        )

    def _border(self):
        """The current run's largest documents in this partition, and the rows held."""
        n = len(self.top)
        ids = np.array([0 if d is None else d for d in self.top], np.int64)
        null = np.array([d is None for d in self.top], bool)
        high, low = (np.full(n, k, np.int64) for k in self.key)
        zeros = np.zeros(n, np.int64)
        yield self._emit(BORDER, high, low, ids, null, zeros, zeros.astype(np.int32))
        for part in self.held:
            yield self._emit(OPEN, *part)

    def run(self, batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                yield from self._take(batch)
        if self.key is not None:
            yield from self._border()

    def _take(self, batch: pa.RecordBatch):
        high, low, block, line = (batch.column(c).to_numpy(False) for c in ("high", "low", "block", "line"))
        null = batch.column("doc_id").is_null().to_numpy(False)
        ids = pc.fill_null(batch.column("doc_id"), 0).to_numpy(False)
        n = len(high)
        new_run, new_doc = np.ones(n, bool), np.ones(n, bool)
        new_run[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        new_run[0] = (int(high[0]), int(low[0])) != self.key
        new_doc[1:] = new_run[1:] | (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        new_doc[0] = new_run[0] or (None if null[0] else int(ids[0])) != self.doc
        starts = np.flatnonzero(new_run)
        count = np.cumsum(new_doc)
        base = np.zeros(n, np.int64)
        base[starts] = count[starts] - 1
        rank = count - np.maximum.accumulate(base)
        head = int(starts[0]) if len(starts) else n
        rank[:head] += self.rank
        columns = (high, low, ids, null, block, line)
        if head:  # rows that go on with the run of the batch before
            yield from self._go_on([c[:head] for c in columns], rank[:head])
        if not len(starts):
            return
        if self.key is not None:
            yield from self._close()
        ends = np.append(starts[1:], n)
        last = int(starts[-1])
        whole = slice(head, last)
        if last > head:  # runs that begin and end in this batch
            total = rank[ends[:-1] - 1]
            sizes = np.diff(starts)
            skip = 0
            if self.is_first_run:  # may go on from the partition before
                skip = int(ends[0]) - head
                yield from self._whole_border([c[head : head + skip] for c in columns], rank[head : head + skip])
                self.is_first_run = False
            goes = (np.repeat(total, sizes) >= self.least) & (rank[whole] > 1)
            goes[:skip] = False
            if goes.any():
                yield self._emit(DROP, *[c[whole][goes] for c in columns])
        self.key, self.rank, self.doc = (int(high[last]), int(low[last])), 0, None
        self.top, self.held = [], []
        yield from self._go_on([c[last:] for c in columns], rank[last:])

    def _whole_border(self, columns, rank):
        self.key, self.top, self.held = (int(columns[0][0]), int(columns[1][0])), [], []
        yield from self._go_on(columns, rank)
        yield from self._border()

    def _go_on(self, columns, rank):
        """Rows of the current run; ``rank`` counts from its first document here."""
        ids, null = columns[2], columns[3]
        if len(self.top) < self.least:
            _, at = np.unique(rank, return_index=True)
            for r, i in zip(rank[at].tolist(), at.tolist(), strict=True):
                if len(self.top) < r <= self.least:
                    self.top.append(None if null[i] else int(ids[i]))
        self.rank = int(rank[-1])
        self.doc = None if null[-1] else int(ids[-1])
        if self.is_first_run:
            # which document is the largest is not known here
            self.held.append(tuple(columns))
            if self.rank >= self.least:
                yield from (self._emit(OPEN, *part) for part in self.held)
                self.held = []
            return
        later = rank > 1
        if self.rank < self.least:
            self.held.append(tuple(c[later] for c in columns))
            return
        yield from (self._emit(DROP, *part) for part in self.held)
        self.held = []
        if later.any():
            yield self._emit(DROP, *[c[later] for c in columns])

    def _close(self):
        """The current run ends within the partition."""
        if self.is_first_run:
            yield from self._border()
            self.is_first_run = False
        self.key, self.top, self.held = None, [], []


def _streamed(least_docs: int):
    def streamed(batches):
        yield from _Stream(least_docs).run(batches)

    return streamed


def dropped_lines(lines: DataFrame, least_docs: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``block, line`` of the rows of ``lines`` (``LINE``) whose key goes in that document."""
    n_ranges = max(LEAST_RANGES, -(-lines.count() // range_rows))
    order = ["high", "low", F.col("doc_id").desc_nulls_last(), "block", "line"]
    ranges = lines.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order)
    found = stored(ranges.mapInArrow(_streamed(least_docs), FOUND), "verdicts", "kind")
    key = ["high", "low"]
    borders = found.filter(F.col("kind") == BORDER).select(*key, "doc_id").distinct()
    verdicts = (
        borders.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("largest"))
        .filter(F.col("n") >= least_docs)
    )
    if 2 * n_ranges <= FEW_BORDERS:  # two hashes for each range at most
        verdicts = F.broadcast(verdicts)
    undecided = found.filter(F.col("kind") == OPEN).join(verdicts, key)
    gone = undecided.filter(~F.col("doc_id").eqNullSafe(F.col("largest")))
    return found.filter(F.col("kind") == DROP).select("block", "line").union(gone.select("block", "line"))


# --- documents


def bitmap(stay: np.ndarray) -> bytes:
    """Compressed bits of the lines that stay; empty if all do."""
    return b"" if stay.all() else zlib.compress(np.packbits(stay).tobytes())


def kept_lines(text: str | None, keep: bytes | None) -> str | None:
    """The lines of a text that its bitmap keeps."""
    if text is None or not keep:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join([line for line, bit in zip(lines, bits.tolist(), strict=True) if bit])


def _bitmaps(names: list[str], least_length: int):
    def bitmaps(stored_block: pa.Table, dropped: pa.Table) -> pa.Table:
        table = _load(stored_block.column("content")[0])
        lines = _Lines(texts(table), least_length)
        stay = lines.kept(dropped.column("line").to_numpy())
        cuts = lines.ends.tolist()
        keep = [bitmap(stay[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        n_lines = np.diff(lines.ends)
        n_kept = np.diff(np.concatenate([[0], np.cumsum(stay)])[lines.ends])
        found = pa.StructArray.from_arrays(
            [pa.array(n_lines), pa.array(n_lines - n_kept), pa.array(keep, pa.binary())],
            ["n_lines", "n_dropped", "keep"],
        )
        columns = {name: column(table, name) for name in table.column_names}
        columns["lines"] = found
        return pa.table({name: columns[name] for name in names})

    return bitmaps


def line_bitmaps(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_docs: int = LEAST_DOCS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``docs`` with ``lines``, a struct of ``n_lines``, ``n_dropped`` and the bitmap ``keep``.

    ``docs(doc_id, text)`` keep all their columns; one named ``lines`` is replaced. Keys of at
    least ``least_length`` code points that at least ``least_docs`` documents hold lose all
    their lines but those of the largest doc_id. Null and empty texts are one empty line.
    Rows of one doc_id are one document, as are all rows without one, which is the smallest.
    ``keep`` holds a bit for each line, see ``kept_lines``. No rows give none.
    """
    docs = docs.drop("lines").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    n_buckets = bucket_count(docs)
    corpus = stored_by(docs.mapInArrow(_store, "block bigint, content binary"), "lines", "block", n_buckets)
    lines = stored(corpus.mapInArrow(_send(least_length), LINE), "keys")
    dropped = dropped_lines(lines, least_docs, range_rows)
    found = "struct<n_lines:bigint,n_dropped:bigint,keep:binary>"
    schema = docs.withColumn("lines", F.lit(None).cast(found)).schema
    return (
        corpus.groupBy("block")
        .cogroup(dropped.groupBy("block"))
        .applyInArrow(_bitmaps(schema.names, least_length), schema)
    )


def _cut(batches):
    for batch in batches:
        texts_, keeps = batch.column("text").to_pylist(), batch.column("_keep_lines").to_pylist()
        kept = [kept_lines(text, keep) for text, keep in zip(texts_, keeps, strict=True)]
        columns = {name: batch.column(name) for name in batch.schema.names if name != "_keep_lines"}
        columns["text"] = pa.array(kept, pa.string())
        yield pa.RecordBatch.from_pydict(columns)


def without_lines(marked: DataFrame) -> DataFrame:
    """The documents of ``line_bitmaps`` with their kept lines as ``text``, without ``lines``."""
    others = [F.col(f"`{name}`") for name in marked.columns if name != "lines"]
    schema = marked.select(*others).schema
    return marked.select(*others, F.col("lines.keep").alias("_keep_lines")).mapInArrow(_cut, schema)


def line_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` for each row of ``docs``."""
    marked = line_bitmaps(docs.select("doc_id", "text"))
    cut = without_lines(marked.select("doc_id", "text", "lines.n_lines", "lines.n_dropped", "lines"))
    return cut.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


# ``line_digest`` in DuckDB SQL, for tables with distinct ids.
LINES_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
common AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, line, position, largest IS NOT NULL AND doc_id <> largest AS dropped
  FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

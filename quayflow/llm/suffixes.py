"""Remove repeated passages of bytes by suffix arrays over shards of candidate text.

Every window of ``LENGTH`` bytes is assigned to one anchor in it, the leftmost smallest
hash among its ``GRAM``-byte strings. Equal windows have equal anchors, so a window can
only repeat if its anchor does; anchors are counted over the corpus and the text around
repeated ones (the run of windows of that anchor) is dealt to the anchors' buckets, equal
texts of a block once. Around anchors that occur very often no texts are gathered: their
windows are counted one by one, by a 96-bit hash that a block sends once for each window,
so what a task gets does not grow with the surroundings of a common passage.

A bucket's distinct texts form shards. A shard's suffix array is made by induced sorting:
suffixes are classified, leftmost-smaller (LMS) substrings are sorted by inducing and
named, the string of names is sorted in the same way if any repeats, and the whole array
is induced from it; all steps run over one first symbol's suffixes at a time as array
operations. Common prefixes are computed in text order: only irreducible ones are
compared, the others follow by counting down. A run of suffixes that share ``LENGTH``
bytes and holds two window starts is a repeat.

Passages can be sought by words as well: windows of so many words, whatever blanks are
between them, get anchors of their own among runs of words, and those of repeated anchors
are counted by their hashes in the same way.

Null texts count as empty; null ids are kept; repeated rows are repeats of each other;
extra columns are ignored; an empty table gives no rows; shorter texts keep all bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, mix, pack, runs, stored_by, texts, unpack
from quayflow.llm.token_counts import bucket_count

LENGTH = 400
GRAM = 128
PHRASE = 51  # words
OFTEN = 4096  # windows of anchors that occur more often are counted by their hashes
PHRASE_SALT = np.uint64(0x8C95B3D1F2E6A74B)
SLICE = 1 << 19
PIECE = 1 << 22
SHARD = 1 << 20
BLOCK = 6 << 20
DIGIT = 10  # bits of a symbol in the texts of names
SHORTER = 0.9  # share of a text's length that the text of its names may have
MESSAGE = "block string, bucket int, message binary"

_BYTE = mix(np.arange(1, 257).astype(np.uint64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    size = max(SLICE, 1 << (n - 1).bit_length()) if n else SLICE
    if size not in _POWERS:
        base = 0x9E3779B97F4A7C15
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _POWERS[size]


def _smallest(order: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(order) - width + 1
    rows = -(-len(order) // width)
    padded = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(order)] = order
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _coded(values: np.ndarray, salt: np.uint64 = np.uint64(0)) -> np.ndarray:
    """Numbers to add up for bytes, or for words given by their hashes."""
    if values.dtype == np.uint8:
        return (mix(_BYTE ^ salt) if salt else _BYTE)[values]
    return mix(values ^ salt)


def word_hashes(data: np.ndarray, ends: np.ndarray):
    """Words between ASCII white space: hashes, first bytes, ends, each text's end in words."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    at = ends[(ends > 0) & (ends < len(data))]
    opens[at] = inside[at]
    closes[at - 1] = inside[at - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = np.empty(len(first), np.uint64)
    at = 0
    while at < len(first):
        stop = max(at + 1, int(np.searchsorted(last, first[at] + SLICE, "right")))
        low, high = first[at], last[stop - 1]
        starts = first[at:stop] - low
        place = np.arange(high - low) - np.repeat(starts, np.diff(np.append(starts, high - low)))
        values = _BYTE[data[low:high]] * _powers(len(place))[0][place]
        values[~inside[low:high]] = 0
        hashes[at:stop] = mix(np.add.reduceat(values, starts))
        at = stop
    return hashes, first, last, np.searchsorted(first, ends, "left")


def _anchored(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: anchor, its place, first window, last window."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_coded(data) * up[: len(data)], out=sums[1:])
    hashed = mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    place = np.arange(len(hashed), dtype=np.uint64)
    width = length - gram + 1
    low = np.uint64((1 << 24) - 1)
    at = (_smallest(hashed & ~low | place, width) & low).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    whole = ends - starts >= length
    size = len(at) + 1
    opened = np.bincount(starts[whole], minlength=size) - np.bincount(
        ends[whole] - length + 1, minlength=size
    )
    window = np.flatnonzero(np.cumsum(opened[:-1]))
    at = at[window]
    first = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
    last = np.append(first[1:], len(window))[: len(first)] - 1
    return hashed[at[first]], at[first], window[first], window[last]


def anchor_runs(data: np.ndarray, ends: np.ndarray, length=LENGTH, gram=GRAM):
    """``_anchored`` over slices of whole documents."""
    parts, at, begin = [], 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
        end = int(ends[stop - 1])
        if stop - at > 1 or end - begin <= PIECE:
            pieces = [(begin, end, ends[at:stop] - begin)]
        else:  # one long document, in pieces that share all but one byte of a window
            lows = range(begin, end - length + 1, PIECE - length + 1)
            pieces = [(x, min(end, x + PIECE), np.array([min(end, x + PIECE) - x])) for x in lows]
        for low, high, inside in pieces:
            if high - low >= length:
                anchor, at_byte, first, last = _anchored(data[low:high], inside, length, gram)
                parts.append((anchor, at_byte + low, first + low, last + low))
        at, begin = stop, end
    if not parts:
        return (np.zeros(0, np.uint64), *np.zeros((3, 0), np.int64))
    return tuple(np.concatenate(part) for part in zip(*parts, strict=True))


def window_hashes(data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, length: int = LENGTH):
    """Windows of runs in order, each once, and 64 and 32 bits of hash for each."""
    opened = np.bincount(firsts, minlength=len(data) + 1) - np.bincount(lasts + 1, minlength=len(data) + 1)
    windows = np.flatnonzero(np.cumsum(opened))
    wide, narrow = np.empty(len(windows), np.uint64), np.empty(len(windows), np.uint32)
    step = SLICE - length
    for begin in range(0, len(data), step):
        a, b = np.searchsorted(windows, [begin, begin + step])
        if a == b:
            continue
        values, at = data[begin : begin + SLICE], windows[a:b] - begin
        up, down = _powers(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        for salt in (np.uint64(0), np.uint64(0x2545F4914F6CDD1D)):
            np.cumsum(_coded(values, salt) * up[: len(values)], out=sums[1:])
            hashed = mix((sums[at + length] - sums[at]) * down[at] ^ salt)
            if salt:
                narrow[a:b] = hashed >> np.uint64(32)
            else:
                wide[a:b] = hashed
    return windows, wide, narrow


# --- suffix arrays of shards


def _is_s(text: np.ndarray) -> np.ndarray:
    """Whether a suffix is smaller than the next; the last one, a sentinel, counts as such."""
    differs = np.append(text[:-1] != text[1:], True)
    ends = np.flatnonzero(differs)
    run = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    smaller = np.ones(len(ends), bool)
    smaller[:-1] = text[ends[:-1]] < text[ends[:-1] + 1]
    return smaller[run]


class _Induction:
    """Induced sorting of all suffixes from an order of the LMS suffixes."""

    def __init__(self, text: np.ndarray, is_s: np.ndarray):
        self.text, self.n = text, len(text)
        self.size = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.size)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.n_large = np.bincount(text[~is_s], minlength=self.size)
        self.used = np.flatnonzero(counts).tolist()

    def _place(self, out, heads, suffixes, symbols, step):
        """Append suffixes to their buckets in order, forwards or backwards."""
        order = np.argsort(symbols, kind="stable")
        counts = np.bincount(symbols, minlength=self.size)
        first = np.cumsum(counts) - counts
        sorted_symbols = symbols[order]
        rank = np.arange(len(order)) - first[sorted_symbols]
        out[heads[sorted_symbols] + step * rank] = suffixes[order]
        heads += step * counts

    def _scan(self, out, heads, found, symbol, step):
        """Place the suffixes before ``found``; go on with those of the same symbol."""
        while len(found):
            before = found[found > 0] - 1
            symbols = self.text[before]
            takes = symbols >= symbol if step > 0 else symbols <= symbol
            before, symbols = before[takes], symbols[takes]
            if not len(before):
                return
            self._place(out, heads, before, symbols, step)
            found = before[symbols == symbol]

    def array(self, lms: np.ndarray) -> np.ndarray:
        """Suffix array; ``lms`` is sorted within equal first symbols at least."""
        out = np.empty(self.n, np.int32)
        heads = self.starts.copy()
        symbols = self.text[lms]
        by_symbol = np.argsort(symbols, kind="stable")
        lms, counts = lms[by_symbol], np.bincount(symbols, minlength=self.size)
        lms_ends = np.cumsum(counts)
        for c in self.used:
            large = out[self.starts[c] : heads[c]].copy()
            self._scan(out, heads, large, c, 1)
            mine = lms[lms_ends[c] - counts[c] : lms_ends[c]]
            if len(mine):
                before = mine[mine > 0] - 1
                self._place(out, heads, before, self.text[before], 1)
        heads = self.ends - 1
        for c in reversed(self.used):
            top = self.starts[c] + self.n_large[c]
            small = out[heads[c] + 1 : self.ends[c]][::-1].copy()
            self._scan(out, heads, small, c, -1)
            large = out[self.starts[c] : top][::-1]
            before = large[large > 0] - 1
            symbols = self.text[before]
            takes = symbols < c
            self._place(out, heads, before[takes], symbols[takes], -1)
        out[0] = self.n - 1  # nothing induces the sentinel
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order. ``text`` ends with its only 0, which is its smallest symbol."""
    is_s = _is_s(text)
    is_lms = is_s.copy()
    is_lms[1:] &= ~is_s[:-1]
    is_lms[0] = False
    lms = np.flatnonzero(is_lms).astype(np.int32)
    induction = _Induction(text, is_s)
    if len(lms) > 1:
        first = induction.array(lms)
        names = _lms_names(text, lms, first[is_lms[first]])
        del first
        lms = lms[_name_order(names, len(text))]
    return induction.array(lms)


def _lms_names(text: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order; equal substrings get equal names."""
    following = np.append(lms[1:], lms[-1])
    place = np.empty(len(text), np.int32)
    place[lms] = np.arange(len(lms))
    number = place[in_order]
    length = (following - lms + 1)[number]
    same = np.zeros(len(in_order), bool)
    same[1:] = length[1:] == length[:-1]
    active = np.flatnonzero(same)
    at = 0
    limit = len(text) - 1
    while len(active):
        a = np.minimum(in_order[active] + at, limit)
        b = np.minimum(in_order[active - 1] + at, limit)
        differ = text[a] != text[b]
        same[active[differ]] = False
        active = active[~differ]
        at += 1
        active = active[length[active] > at]
    names = np.empty(len(lms), np.int64)
    names[number] = np.cumsum(~same) - 1
    return names


def _name_order(names: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of a string of names of a text of ``size`` symbols.

    Names that repeat make a shorter text, whose suffixes are sorted in turn. The induction
    runs over a text's symbols one by one, so a name is written as few digits of at most
    ``DIGIT`` bits there. Should that not be shorter, the names are sorted by doubling.
    """
    n, top = len(names), int(names.max())
    if top == n - 1:
        return np.argsort(names, kind="stable")
    n_digits = -(-max(1, top.bit_length()) // DIGIT)
    if n * n_digits > SHORTER * size:
        return _doubled(names)
    bits = -(-max(1, top.bit_length()) // n_digits)
    shifts = bits * np.arange(n_digits - 1, -1, -1)
    digits = (names[:, None] >> shifts & ((1 << bits) - 1)).astype(np.int32) + 1
    array = suffix_array(np.append(digits.ravel(), 0).astype(np.int32))
    array = array[array % n_digits == 0] // n_digits
    return array[array < n]


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names by doubling the length compared."""
    n = len(names)
    rank, covered = names, 1
    order = np.argsort(rank, kind="stable")
    while covered < n:
        width = np.int64(n + 1)
        second = np.zeros(n, np.int64)
        second[: n - covered] = rank[covered:] + 1 if covered < n else 0
        key = rank * width + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.diff(sorted_key, prepend=sorted_key[:1]) != 0)
        rank, covered = new, covered * 2
        if rank[order[-1]] == n - 1:
            break
    return order


def common_prefixes(text: np.ndarray, array: np.ndarray, heads: np.ndarray, most: int) -> np.ndarray:
    """Length shared with the suffix before in the array, in text order, up to ``most``.

    Where the suffixes one position earlier are neighbours too, the length is theirs less
    one. The others are compared, and so are the positions ``heads``, after which callers
    look at fewer positions than ``most`` exceeds the length that matters to them.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[array[1:]] = array[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[:-1] >= 0) & (before[1:] == before[:-1] + 1)
    follows[1:] &= text[:-1] == text[before[:-1]]
    follows[heads] = False
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    eight = np.zeros(n + 8, np.uint64)
    for k in range(8):
        eight |= padded[k : k + n + 8].astype(np.uint64) << np.uint64(8 * k)
    shared = np.zeros(n, np.int32)
    active = np.flatnonzero(~follows & (before >= 0))
    other = before[active].astype(np.int64)
    at = 0
    while len(active) and at < most:
        differ = eight[np.minimum(active + at, n)] ^ eight[np.minimum(other + at, n)]
        end = differ != 0
        low = differ[end] & (~differ[end] + np.uint64(1))
        shared[active[end]] = at + np.bitwise_count(low - np.uint64(1)).astype(np.int32) // 8
        active, other = active[~end], other[~end]
        at += 8
    shared[active] = at
    rows = np.arange(n, dtype=np.int32)
    source = np.maximum.accumulate(np.where(follows, 0, rows))
    return np.maximum(shared[source] - (rows - source), 0)


def repeated_starts(passages: list[bytes], starts: np.ndarray, times: np.ndarray, length: int = LENGTH):
    """Of distinct passages, which of the first ``starts`` positions begin a repeat.

    Passage i occurs ``times[i]`` times. Returns an array of truth values for each.
    """
    sizes = np.array([len(p) for p in passages], np.int64)
    # UTF-8 has no bytes above 244: 0 ends the shard and 1 each passage
    text = np.frombuffer(b"".join(p + b"\xff" for p in passages) + b"\xfe", np.uint8) + np.uint8(2)
    heads = np.cumsum(sizes + 1) - sizes - 1
    array = suffix_array(text)
    shared = common_prefixes(text, array, heads, length + int(starts.max(initial=0)) + 8)
    run = np.cumsum(shared[array] < length)
    within = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    begins = np.repeat(heads, starts) + within
    weight = np.zeros(len(text))
    weight[begins] = np.repeat(times, starts)
    held = np.bincount(run, weights=weight[array])
    repeated = np.zeros(len(text), bool)
    repeated[array] = held[run] >= 2
    return np.split(repeated[begins], np.cumsum(starts)[:-1])


# --- the corpus


def _store(batches):
    """Blocks of texts, with their other columns aside."""
    for number, table in enumerate(blocks(batches, size=BLOCK)):
        text = texts(table)
        rest = table.drop_columns(["text"]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rest)
        data = np.frombuffer("".join(text.to_pylist()).encode(), np.uint8)
        yield pa.RecordBatch.from_pydict(
            {
                "block": [f"{TaskContext.get().partitionId()}-{number}"],
                "message": pa.array([pack(pc.binary_length(text).to_numpy().astype(np.int64), data)]),
                "rest": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            }
        )


def _load(message: bytes) -> tuple[np.ndarray, np.ndarray]:
    lengths, data = unpack(message)
    return data, np.cumsum(lengths)


def _by_bucket(keys: np.ndarray, n_buckets: int):
    """Bucket by bucket, the places of its keys in key order."""
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    for b, first, last in runs(bucket[order]):
        yield b, order[first:last]


def _message_rows(block: str, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "block": pa.array([block] * len(rows), pa.string()),
            "bucket": pa.array([b for b, _ in rows], pa.int32()),
            "message": pa.array([m for _, m in rows], pa.binary()),
        }
    )


def _phrase_runs(data: np.ndarray, ends: np.ndarray, phrase: int):
    """Words of a block and the runs of windows of ``phrase`` of them."""
    hashes, first, last, word_ends = word_hashes(data, ends)
    runs = anchor_runs(hashes, word_ends, phrase, max(1, phrase // 3))
    return (hashes, first, last), (runs[0] ^ PHRASE_SALT, *runs[1:])


def _ask(n_buckets: int, phrase: int | None):
    def ask(batches):
        for batch in batches:
            for block, message in zip(batch.column("block"), batch.column("message"), strict=True):
                data, ends = _load(message.as_py())
                anchors = anchor_runs(data, ends)[0]
                if phrase:
                    anchors = np.concatenate([anchors, _phrase_runs(data, ends, phrase)[1][0]])
                anchors, times = np.unique(anchors, return_counts=True)
                rows = [
                    (b, pack(np.diff(anchors[at], prepend=np.uint64(0)), times[at].astype(np.int32)))
                    for b, at in _by_bucket(anchors, n_buckets)
                ]
                yield from _message_rows(block.as_py(), rows).to_batches()

    return ask


def _count(often: int):
    """0 for anchors that occur once, 1 for those that repeat, 2 for frequent ones."""

    def count(table: pa.Table) -> pa.Table:
        asked = [unpack(m.as_py()) for m in table.column("message")]
        keys = [np.cumsum(steps, dtype=np.uint64) for steps, _ in asked]
        anchors, at = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate([t for _, t in asked]), minlength=len(anchors))
        code = ((times > 1).astype(np.uint8) + (times > often))[at]
        cut = np.split(code, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "message": pa.array([pack(c) for c in cut], pa.binary()),
            }
        )

    return count


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _gather(n_buckets: int, phrase: int | None):
    """Send the texts around repeated anchors to their buckets, window hashes of frequent ones.

    The hashes' buckets follow those of the texts, and those of words the hashes'.
    """

    def gather(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        block = corpus.column("block")[0].as_py()
        data, ends = _load(corpus.column("message")[0].as_py())
        found = anchor_runs(data, ends)
        anchors = found[0]
        if phrase:
            (hashes, first, last), runs = _phrase_runs(data, ends, phrase)
            anchors = np.concatenate([anchors, runs[0]])
        anchors = np.unique(anchors)
        code = np.zeros(len(anchors), np.uint8)
        answer = dict(zip(answers.column("bucket").to_pylist(), answers.column("message"), strict=True))
        for b, at in _by_bucket(anchors, n_buckets):
            code[at] = unpack(answer[b].as_py())[0]
        frequent = _among(found[0], anchors[code == 2])
        rows = []
        if frequent.any():
            windows, wide, narrow = window_hashes(data, found[2][frequent], found[3][frequent])
            rows += _window_rows(wide, narrow, windows, np.full(len(windows), LENGTH), n_buckets)
        if phrase and (met := _among(runs[0], anchors[code > 0])).any():
            windows, wide, narrow = window_hashes(hashes, runs[2][met], runs[3][met], phrase)
            begin = first[windows]
            sizes = last[windows + phrase - 1] - begin
            rows += [(n_buckets + b, m) for b, m in _window_rows(wide, narrow, begin, sizes, n_buckets)]
        sent = _among(found[0], anchors[code == 1])
        places: dict[tuple[int, int, bytes], list[int]] = {}
        raw = data.tobytes()
        for key, low, high in zip(*(found[i][sent].tolist() for i in (0, 2, 3)), strict=True):
            places.setdefault((key, high - low + 1, raw[low : high + LENGTH]), []).append(low)
        passages = list(places)
        keys = np.array([p[0] for p in passages], np.uint64)
        for b, at in _by_bucket(keys, n_buckets):
            mine = [passages[i] for i in at.tolist()]
            lows = [places[p] for p in mine]
            rows.append(
                (
                    b,
                    pack(
                        keys[at],
                        np.array([p[1] for p in mine], np.int32),
                        np.array([len(x) for x in lows], np.int32),
                        np.array([x for low in lows for x in low], np.int32),
                        np.frombuffer(b"".join(p[2] for p in mine), np.uint8),
                    ),
                )
            )
        return _message_rows(block, rows)

    return gather


def _window_rows(wide, narrow, lows, sizes, n_buckets: int) -> list[tuple[int, bytes]]:
    """Messages of a block's distinct windows: their hashes, times, places and sizes."""
    order = np.lexsort((narrow, wide))
    wide, narrow = wide[order], narrow[order]
    lows, sizes = lows[order].astype(np.int32), sizes[order].astype(np.int32)
    fresh = np.ones(len(wide), bool)
    fresh[1:] = (wide[1:] != wide[:-1]) | (narrow[1:] != narrow[:-1])
    begin = np.flatnonzero(fresh)
    times = np.diff(np.append(begin, len(wide)))
    rows = []
    for b, at in _by_bucket(wide[begin], n_buckets):
        places = np.repeat(begin[at], times[at]) + np.arange(times[at].sum()) - np.repeat(
            np.cumsum(times[at]) - times[at], times[at]
        )
        steps = np.diff(wide[begin[at]], prepend=np.uint64(0))
        parts = steps, narrow[begin[at]], times[at].astype(np.int32), lows[places], sizes[places]
        rows.append((n_buckets + b, pack(*parts)))
    return rows


def _count_windows(table: pa.Table) -> list[np.ndarray]:
    """For each message, the first and last bytes' ends of its windows that repeat."""
    asked = [unpack(message.as_py()) for message in table.column("message")]
    wide = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, *_ in asked])
    narrow = np.concatenate([n for _, n, *_ in asked])
    times = np.concatenate([t for _, _, t, *_ in asked])
    order = np.lexsort((narrow, wide))
    fresh = np.ones(len(wide), bool)
    fresh[1:] = (np.diff(wide[order]) != 0) | (np.diff(narrow[order]) != 0)
    group = np.empty(len(wide), np.int64)
    group[order] = np.cumsum(fresh) - 1
    repeated = np.bincount(group, weights=times)[group] > 1
    out, at = [], 0
    for _, n, t, lows, sizes in asked:
        taken = np.repeat(repeated[at : at + len(n)], t)
        at += len(n)
        order = np.argsort(lows[taken], kind="stable")
        lows = lows[taken][order].astype(np.int64)
        ends = np.maximum.accumulate(lows + sizes[taken][order])
        first = np.flatnonzero(np.append(True, lows[1:] >= ends[:-1])[: len(lows)])
        last = np.append(first[1:], len(lows))[: len(first)] - 1
        out.append(np.stack([lows[first], ends[last]], 1))
    return out


def _mark(n_buckets: int):
    """Find the repeats that a bucket got; answer with the bytes to remove."""

    def mark(table: pa.Table) -> pa.Table:
        by_hash = table.column("bucket")[0].as_py() >= n_buckets
        spans = _count_windows(table) if by_hash else _mark_passages(table)
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "message": pa.array([pack(s[:, 0].copy(), s[:, 1].copy()) for s in spans], pa.binary()),
            }
        )

    return mark


def _mark_passages(table: pa.Table) -> list[np.ndarray]:
    """Find the repeats among a bucket's passages."""
    # anchor -> passage -> [times, windows, (message, place of its lows)]
    anchors: dict[int, dict[bytes, list]] = {}
    lows, removed = [], [[] for _ in range(table.num_rows)]
    for m, message in enumerate(table.column("message")):
        keys, windows, times, low, data = unpack(message.as_py())
        raw, end, at = data.tobytes(), 0, 0
        lows.append(low)
        for key, n, t in zip(keys.tolist(), windows.tolist(), times.tolist(), strict=True):
            size = n + LENGTH - 1
            entry = anchors.setdefault(key, {}).setdefault(raw[end : end + size], [0, n, []])
            entry[0] += t
            entry[2].append((m, at, at + t))
            end, at = end + size, at + t

    def take(entries: list[list], flags: list[np.ndarray]) -> None:
        for (_, _, uses), flag in zip(entries, flags, strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
            for first, last in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                for m, a, b in uses:
                    spot = lows[m][a:b].astype(np.int64)
                    removed[m].append(np.stack([spot + first, spot + last - 1 + LENGTH], 1))

    shard: list[tuple[bytes, list]] = []
    size = 0

    def settle() -> None:
        entries = [entry for _, entry in shard]
        windows = np.array([entry[1] for entry in entries])
        times = np.array([entry[0] for entry in entries])
        take(entries, repeated_starts([p for p, _ in shard], windows, times))
        shard.clear()

    for key in sorted(anchors):
        passages = anchors.pop(key)
        if len(passages) == 1:
            entry = next(iter(passages.values()))
            take([entry], [np.full(entry[1], entry[0] > 1)])
            continue
        shard.extend(sorted(passages.items()))
        size += sum(map(len, passages))
        if size >= SHARD:
            settle()
            size = 0
    if shard:
        settle()
    return [np.concatenate(r) if r else np.zeros((0, 2), np.int64) for r in removed]


def _covered(size: int, marks: list) -> np.ndarray:
    """Which bytes of a block its marks cover."""
    change = np.zeros(size + 1, np.int32)
    for message in marks:
        first, last = unpack(message.as_py())
        np.add.at(change, first, 1)
        np.add.at(change, last, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _sums(gone: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(gone) + 1, np.int32)
    np.cumsum(gone, out=sums[1:])
    return sums


def _cut(names: list[str], n_buckets: int, cut_phrases: bool):
    def cut(corpus: pa.Table, marks: pa.Table) -> pa.Table:
        data, ends = _load(corpus.column("message")[0].as_py())
        rest = pa.ipc.open_stream(corpus.column("rest")[0].as_py()).read_all()
        starts = np.concatenate([[0], ends[:-1]])
        by_words = marks.column("bucket").to_numpy() >= 2 * n_buckets
        messages = list(zip(marks.column("message"), by_words.tolist(), strict=True))
        gone = _covered(len(data), [m for m, words in messages if words])
        sums = _sums(gone)
        in_phrases = sums[ends] - sums[starts]
        if cut_phrases:
            gone |= _covered(len(data), [m for m, words in messages if not words])
        else:
            gone = _covered(len(data), [m for m, words in messages if not words])
        sums = _sums(gone)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        opening = starts[starts < len(data)]
        begins[opening] = gone[opening]
        spans = np.zeros(len(data) + 1, np.int32)
        np.cumsum(begins, out=spans[1:])
        raw = data[~gone].tobytes()
        kept_ends = (ends - sums[ends]).tolist()
        kept = [raw[a:b] for a, b in zip([0, *kept_ends], kept_ends, strict=False)]
        columns = {name: rest.column(name) for name in rest.column_names}
        # a character that is cut in two is left out of the text
        columns["text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        columns["repeats"] = pa.StructArray.from_arrays(
            [
                pa.array(ends - starts, pa.int64()),
                pa.array(sums[ends] - sums[starts]).cast(pa.int64()),
                pa.array(spans[ends] - spans[starts]).cast(pa.int64()),
                pa.array(in_phrases).cast(pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["n_bytes", "n_removed", "n_spans", "n_phrase_bytes", "kept"],
        )
        return pa.table({name: columns[name] for name in names})

    return cut


def remove_repeats(
    docs: DataFrame, often: int = OFTEN, phrase: int | None = None, cut_phrases: bool = True
) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and ``repeats``.

    ``repeats`` is a struct of ``n_bytes`` of the text before, ``n_removed`` of them,
    ``n_spans`` removed in a run, ``n_phrase_bytes`` in repeated phrases, and ``kept``, the
    bytes left. A column of that name is replaced. Windows of anchors that occur more than
    ``often`` times are counted by hashes. With ``phrase``, passages of so many words or more
    are repeats too, however short; they are only counted if not ``cut_phrases``.
    """
    docs = docs.drop("repeats")
    n_buckets = bucket_count(docs)
    corpus = stored_by(
        docs.mapInArrow(_store, "block string, message binary, rest binary"), "texts", "block", n_buckets
    )
    answers = (
        corpus.select("block", "message")
        .mapInArrow(_ask(n_buckets, phrase), MESSAGE)
        .groupBy("bucket")
        .applyInArrow(_count(often), MESSAGE)
    )
    by_block = corpus.select("block", "message").groupBy("block")
    passages = by_block.cogroup(answers.groupBy("block")).applyInArrow(_gather(n_buckets, phrase), MESSAGE)
    marks = passages.groupBy("bucket").applyInArrow(_mark(n_buckets), MESSAGE)
    found = "struct<n_bytes:long,n_removed:long,n_spans:long,n_phrase_bytes:long,kept:binary>"
    schema = docs.withColumn("repeats", F.lit(None).cast(found)).schema
    cut = _cut(schema.names, n_buckets, cut_phrases)
    return corpus.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(cut, schema)


def repeat_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_phrase_bytes`` for each row.

    The last one counts the bytes in passages of ``PHRASE`` words or more that occur again,
    which may be shorter than ``LENGTH`` bytes and then stay.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_repeats(docs, phrase=PHRASE, cut_phrases=False).select(
        "doc_id",
        "repeats.n_bytes",
        "repeats.n_removed",
        "repeats.n_spans",
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
        "repeats.n_phrase_bytes",
    )

"""SentencePiece segmentations sampled without replacement, and decoding.

A text's segmentations into pieces form a lattice, whose weight is the product over its
units (runs of blanks with the word after them, which no piece crosses). A piece's weight
falls with its merge rank, ``1 / (rank + SMOOTH)``; characters without a piece are spelled
in byte pieces.

Gumbel-top-k: every segmentation's log probability is perturbed by a Gumbel variable and
the k largest are taken, found best-first without listing the others. The best one of a
set of segmentations is a plain sample of it, drawn by backward sampling in the lattice;
what differs from it first at unit t is a subtree with a known mass, whose maximum is a
Gumbel variable below the parent's. The search (A*, with those maxima as exact bounds)
takes the largest subtree, samples its best segmentation and splits what is left again.
The k + 1st maximum gives each sample's inclusion probability.

All random numbers are hashes of the row's id, the sample, the unit and the step, so
reruns and other partitionings agree. Null and empty texts have one segmentation, the
empty one; null ids share a key; repeated rows give equal samples; texts with fewer than
k segmentations give all of them; extra columns are ignored; an empty table gives no rows.
A text's own U+2581 is a blank to the model, whose sign for one it is, and decodes as one.
One text is searched whole: its task needs some 120 times its bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, mix, texts

SMOOTH = 10
BYTE_RANK = 1 << 16
BLOCK = 2 << 20
BLANK = "▁"
SEED = 7
ROWS = (
    "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, "
    "log_inclusion double, pieces binary"
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_LEAST_MASS = 1e-9


class Vocabulary:
    """Pieces of a model file: hashes of their beginnings, weights, and their bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.zeros(256, np.int64)
        self.decoded: list[bytes] = []
        begins: dict[int, int] = {}
        weight = np.full(self.size, -np.inf)
        self.longest = 1
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.decoded.append(bytes([int(piece[1:-1], 16)]))
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.decoded.append(b"")
                continue
            if BLANK in piece.lstrip(BLANK):
                raise ValueError(f"piece {piece!r} crosses a word boundary")
            self.decoded.append(piece.replace(BLANK, " ").encode())
            rank = min(max(0.0, -model.get_score(i)), BYTE_RANK)
            weight[i] = -np.log(rank + SMOOTH)
            self.longest = max(self.longest, len(piece))
            h = 0
            for n, character in enumerate(piece, 1):
                h = (h * int(_BASE) + ord(character) + 1) % (1 << 64)
                begins.setdefault(h, -1)
                if n == len(piece):
                    begins[h] = i
        spread = {h * int(_SPREAD) % (1 << 64): i for h, i in begins.items()}
        self.begins = np.array([*sorted(spread), (1 << 64) - 1], np.uint64)
        self.piece = np.array([*(spread[h] for h in sorted(spread)), -1], np.int32)
        slots = (self.begins[:-1] >> np.uint64(48)).astype(np.int64)
        self.slot = np.searchsorted(slots, np.arange(1 << 16)).astype(np.int32)
        self.pool = np.frombuffer(b"".join(self.decoded), np.uint8)
        self.pool_length = np.array([len(d) for d in self.decoded], np.int32)
        self.pool_start = np.cumsum(self.pool_length, dtype=np.int32) - self.pool_length
        self.weight = weight
        self.byte_weight = -np.log(BYTE_RANK + SMOOTH)


    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each beginning among those of the vocabulary, or -1."""
        wanted = hashes * _SPREAD
        at = self.slot[(wanted >> np.uint64(48)).astype(np.int64)]
        value = self.begins[at]
        out = np.where(value == wanted, at, -1)
        on = np.flatnonzero(value < wanted)
        at, wanted = at[on], wanted[on]
        while len(on):  # a slot holds a few beginnings in order
            at = at + 1
            value = self.begins[at]
            hit = value == wanted
            out[on[hit]] = at[hit]
            more = value < wanted
            on, at, wanted = on[more], at[more], wanted[more]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Lattices of distinct units: edges by end, with running shares for sampling."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, v: Vocabulary):
        lengths = lengths.astype(np.int32)
        ends = np.cumsum(lengths, dtype=np.int32)
        units = np.arange(len(lengths), dtype=np.int32)
        self.first = ends - lengths  # a unit's first character
        self.stop = ends + units  # its last state; states: characters + 1
        owner = np.repeat(units, lengths)
        place = np.arange(ends[-1], dtype=np.int32)
        chars = codes[place + (starts.astype(np.int32) - self.first)[owner]].astype(np.uint64) + np.uint64(1)
        state = place + owner
        stop = self.stop[owner]
        # edges by length of piece, as long as some piece begins so
        active = place
        h = np.zeros(len(chars), np.uint64)
        source, end, piece = [], [], []
        single = np.zeros(len(chars), bool)
        for n in range(1, v.longest + 1):
            h = h * _BASE + chars[active + (n - 1)]
            at = v.find(h)
            known = at >= 0
            found = np.flatnonzero(known & (v.piece[at] >= 0))
            own = state[active[found]]
            source.append(own)
            end.append(own + np.int32(n))
            piece.append(v.piece[at[found]])
            if n == 1:
                single[found] = True
            going = np.flatnonzero(known & (state[active] + n < stop[active]))
            active, h = active[going], h[going]
            if not len(active):
                break
        spelled = np.flatnonzero(~single)
        source.append(state[spelled])
        end.append(state[spelled] + np.int32(1))
        # bytes of a character, as a negative number that holds the character
        piece.append((-chars[spelled].astype(np.int64)).astype(np.int32))
        # long pieces first: they are likely, and a draw looks at edges in order
        source, end, piece = (np.concatenate(x[::-1]) for x in (source, end, piece))
        order = np.argsort(end, kind="stable")
        end, self.source, self.piece = end[order], source[order], piece[order]
        begin_of = np.repeat(self.first + units, lengths + 1)  # of a state, its unit's first
        relative = end - begin_of[end]
        del active, h, chars, state, stop, owner, place, source, piece, order, begin_of
        self.weight = v.weight[self.piece]
        odd = np.flatnonzero(self.piece < 0)
        self.weight[odd] = v.byte_weight * _utf8_length(-self.piece[odd].astype(np.int64) - 1)
        n_states = int(self.stop[-1]) + 1
        self.mass = np.full(n_states, -np.inf)
        self.mass[self.first + units] = 0.0
        self._forward(end, relative)
        self.share = np.exp(self.mass[self.source] + self.weight - self.mass[end])
        self.cut = np.zeros(n_states + 1, np.int32)
        np.cumsum(np.bincount(end, minlength=n_states), out=self.cut[1:])
        self.running = np.cumsum(self.share)
        self.running -= np.concatenate([[0.0], self.running])[self.cut[:-1]][end]
        # the last edge of a state takes what rounding leaves
        self.running[self.cut[1:][np.diff(self.cut) > 0] - 1] = 2.0

    def _forward(self, end: np.ndarray, relative: np.ndarray) -> None:
        """Log mass of the paths to each state, one character after the other."""
        longest = int(relative.max(initial=0))
        by_step = np.argsort(relative.astype(np.uint16 if longest < 1 << 16 else np.int64), kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.bincount(relative, minlength=longest + 1))])
        for a, b in zip(steps[1:-1], steps[2:], strict=True):
            edges = by_step[a:b]
            if not len(edges):
                continue
            value = self.mass[self.source[edges]] + self.weight[edges]
            ends = end[edges]
            heads = np.flatnonzero(np.diff(ends, prepend=-1))
            top = np.maximum.reduceat(value, heads)
            value -= np.repeat(top, np.diff(np.append(heads, len(ends))))
            self.mass[ends[heads]] = top + np.log(np.add.reduceat(np.exp(value), heads))

    def sample(self, unit: np.ndarray, keys: np.ndarray):
        """Draw a path for each of ``unit``: edges in reverse, as (row, step, edge) arrays."""
        state = self.stop[unit]
        rows, out = np.arange(len(unit)), []
        start = self.first[unit] + unit
        step = 0
        while len(rows):
            point = _uniform(keys, step)
            edge = self.cut[state]
            on = np.flatnonzero(self.running[edge] < point)
            while len(on):
                edge[on] += 1
                on = on[self.running[edge[on]] < point[on]]
            out.append((rows, step, edge))
            state = self.source[edge]
            going = np.flatnonzero(state > start)
            rows, state, start, keys = rows[going], state[going], start[going], keys[going]
            step += 1
        return out

    def draw_other(self, unit: int, excluded: set, key: np.ndarray) -> tuple:
        """A path of the unit among those that are not excluded, by their shares."""
        # paths in reverse with the shares of what is still to come
        open_paths = []
        for path in excluded:
            back = path[::-1]
            rest = np.cumprod(self.share[list(path)])[::-1].tolist()
            open_paths.append((back, rest))
        state, start = int(self.stop[unit]), int(self.first[unit]) + unit
        out: list[int] = []
        while state > start:
            edges = range(int(self.cut[state]), int(self.cut[state + 1]))
            weights = []
            for edge in edges:
                gone = sum(rest[len(out)] for back, rest in open_paths if back[len(out)] == edge)
                left = float(self.share[edge]) - gone
                weights.append(left if left > 1e-15 else 0.0)
            point = float(_uniform(key, len(out))[0]) * sum(weights)
            chosen = edges[-1]
            for edge, weight in zip(edges, weights, strict=True):
                if weight and point <= weight:
                    chosen = edge
                    break
                point -= weight
            open_paths = [
                x for x in open_paths if x[0][len(out)] == chosen and len(x[0]) > len(out) + 1
            ]
            out.append(chosen)
            state = int(self.source[chosen])
        return tuple(reversed(out))


def _utf8_length(code: np.ndarray) -> np.ndarray:
    return 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)


def _salt(number: int) -> np.uint64:
    return np.uint64(number * 0xA24BAED4963EE407 % (1 << 64))


def _uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers strictly between 0 and 1, fixed by the keys and the step."""
    bits = mix(keys + _salt(step)) >> np.uint64(11)
    return (bits.astype(np.float64) + 0.5) / float(1 << 53)


def _flat(drawn, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges in reading order and the rows' ends."""
    count = np.zeros(n, np.int64)
    for rows, _, _ in drawn:
        count[rows] += 1
    ends = np.cumsum(count)
    edges = np.empty(int(ends[-1]) if n else 0, np.int32)
    for rows, step, edge in drawn:
        edges[ends[rows] - 1 - step] = edge
    return edges, ends


class _Path:
    """A segmentation of each text of a block: edges by unit and the units' log shares.

    ``excluded`` is the share of a unit's segmentations that are taken at it, ``bound``
    the largest perturbed value of what leaves the path there.
    """

    def __init__(self, edges: np.ndarray, ends: np.ndarray, log_share: np.ndarray):
        self.edges, self.ends, self.log_share = edges, ends, log_share
        self.starts = np.concatenate([[0], ends[:-1]])
        self.excluded = np.exp(log_share)
        self.bound = np.full(len(ends), -np.inf)

    def of(self, unit: int) -> tuple:
        return tuple(self.edges[self.starts[unit] : self.ends[unit]].tolist())


class Sampler:
    """Segmentations of a block of texts."""

    def __init__(self, values: list[str], keys: np.ndarray, v: Vocabulary):
        self.v, self.keys, self.n = v, keys, len(values)
        coded = "".join(BLANK + t.replace(" ", BLANK) for t in values if t).encode("utf-32-le")
        codes = np.frombuffer(coded, np.uint32)
        sizes = np.array([len(t) + 1 if t else 0 for t in values], np.int64)
        opening = (np.cumsum(sizes) - sizes)[sizes > 0]
        blank = codes == ord(BLANK)
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[opening] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(codes)))
        # texts that begin with blanks keep them in the first unit
        self.doc = np.repeat(np.flatnonzero(sizes), np.diff(np.append(np.searchsorted(starts, opening), len(starts))))
        self.doc_ends = np.searchsorted(self.doc, np.arange(self.n), "right")
        self.doc_starts = np.concatenate([[0], self.doc_ends[:-1]])
        self.n_units = len(starts)
        if not self.n_units:
            return
        name = _unit_hashes(codes, starts, lengths)
        _, where, self.unit = np.unique(name, return_index=True, return_inverse=True)
        self.lattice = Lattice(codes, starts[where], lengths[where], v)
        self.total = self.lattice.mass[self.lattice.stop]
        number = np.arange(self.n_units) - self.doc_starts[self.doc]
        self.unit_key = mix(keys[self.doc] ^ mix(number.astype(np.uint64)))

    def draw(self, sample: int) -> _Path:
        """A plain sample of every unit."""
        keys = self.unit_key + _salt(sample)
        return self._path(*_flat(self.lattice.sample(self.unit, keys), self.n_units))

    def _path(self, edges: np.ndarray, ends: np.ndarray) -> _Path:
        weight = np.add.reduceat(self.lattice.weight[edges], np.concatenate([[0], ends[:-1]]))
        return _Path(edges, ends, np.minimum(weight - self.total[self.unit], 0))

    def _bound(self, path: _Path, at: np.ndarray, most: np.ndarray, number: int) -> None:
        """Largest perturbed values, below ``most``, of what leaves ``path`` at units ``at``."""
        before = np.cumsum(path.log_share) - path.log_share
        before -= before[self.doc_starts[self.doc]]
        left = 1 - path.excluded[at]
        mass = before[at] + np.log(np.maximum(left, _LEAST_MASS))
        keys = self.unit_key[at] + _salt(number)
        path.bound[at] = np.where(left < _LEAST_MASS, -np.inf, _below(mass, most, _uniform(keys, 0)))

    def search(self, k: int):
        """Yield (rows, log probability, perturbed value, path) best first, then the next
        perturbed value of every row."""
        rows = np.arange(self.n)
        best = -np.log(-np.log(_uniform(self.keys, 1)))
        if not self.n_units:
            yield rows, np.zeros(self.n), best, None
            yield np.full(self.n, -np.inf)
            return
        path = self.draw(0)
        self._bound(path, np.arange(self.n_units), best[self.doc], 1000)
        paths = [path]
        taken: dict[tuple[int, int], set] = {}
        yield rows, self._log_prob(path), best, path
        has = self.doc_ends > self.doc_starts
        for sample in range(1, k + 1):
            best, owner = np.full(self.n, -np.inf), np.zeros(self.n, np.int64)
            for p, path in enumerate(paths):
                highest = np.full(self.n, -np.inf)
                highest[has] = np.maximum.reduceat(path.bound, self.doc_starts[has])
                owner[highest > best] = p
                best = np.maximum(best, highest)
            if sample == k:
                yield best
                return
            alive = np.flatnonzero(best > -np.inf)
            paths.append(self._branch(paths, owner, best, alive, sample, taken))
            yield alive, self._log_prob(paths[-1]), best, paths[-1]

    def _branch(self, paths, owner, best, alive, sample, taken) -> _Path:
        """The best segmentation of each text's best subtree, which is split by it."""
        fresh = self.draw(sample)
        at = np.full(self.n, -1)  # the unit where the subtree leaves its path
        for p, path in enumerate(paths):
            hit = np.flatnonzero((path.bound == best[self.doc]) & (owner[self.doc] == p))
            hit = hit[path.bound[hit] > -np.inf]
            docs, first = np.unique(self.doc[hit], return_index=True)
            at[docs] = hit[first]
        nodes = []
        for d in alive.tolist():
            place = (int(owner[d]), int(at[d]))
            if place not in taken:
                taken[place] = {paths[place[0]].of(place[1])}
            nodes.append(taken[place])
        other = self._others(at[alive], nodes, fresh, sample)
        for node, segmentation in zip(nodes, other, strict=True):
            node.add(segmentation)
        # units before the leaving one are the parent's, those after it are fresh
        lengths = np.array([len(o) for o in other], np.int64)
        pool = [path.edges for path in paths] + [fresh.edges, np.array([e for o in other for e in o], np.int32)]
        offsets = np.cumsum([0, *map(len, pool)])
        source = fresh.starts + offsets[-3]
        count = fresh.ends - fresh.starts
        unit = np.arange(self.n_units)
        for p, path in enumerate(paths):
            mine = (owner[self.doc] == p) & (unit < at[self.doc])
            source[mine] = path.starts[mine] + offsets[p]
            count[mine] = (path.ends - path.starts)[mine]
        source[at[alive]] = offsets[-2] + np.cumsum(lengths) - lengths
        count[at[alive]] = lengths
        ends = np.cumsum(count)
        gather = np.repeat(source - (ends - count), count) + np.arange(ends[-1])
        new = self._path(np.concatenate(pool)[gather], ends)
        # the parent's bound goes on covering what is left at the leaving unit
        later = np.flatnonzero((at[self.doc] >= 0) & (unit > at[self.doc]))
        self._bound(new, later, best[self.doc[later]], 1000 + sample)
        for p, path in enumerate(paths):
            mine = alive[owner[alive] == p]
            path.excluded[at[mine]] += np.exp(new.log_share[at[mine]])
            self._bound(path, at[mine], best[mine], 3000 + sample)
        return new

    def _others(self, units, excluded: list[set], fresh: _Path, sample: int) -> list[tuple]:
        """A segmentation of each unit that is not excluded: the fresh one or a draw from the rest."""
        out = [fresh.of(u) for u in units.tolist()]
        for i, unit in enumerate(units.tolist()):
            tries = 0
            while out[i] in excluded[i]:  # once, but for rounding
                key = self.unit_key[unit] ^ mix(np.array([(sample << 32) + tries], np.uint64))
                out[i] = self.lattice.draw_other(int(self.unit[unit]), excluded[i], key)
                tries += 1
        return out

    def _log_prob(self, path: _Path) -> np.ndarray:
        out = np.zeros(self.n)
        has = self.doc_ends > self.doc_starts
        out[has] = np.add.reduceat(path.log_share, self.doc_starts[has])
        return out

    def pieces(self, path: _Path | None) -> list[np.ndarray]:
        """Piece ids of each text."""
        if path is None:
            return [np.zeros(0, np.int64)] * self.n
        piece = self.lattice.piece[path.edges]
        spelled = np.flatnonzero(piece < 0)
        count = np.ones(len(piece), np.int64)
        count[spelled] = _utf8_length(-piece[spelled] - 1)
        ends = np.cumsum(count)
        ids = np.empty(int(ends[-1]), np.int64)
        ids[ends[piece >= 0] - 1] = piece[piece >= 0]
        if len(spelled):
            data = "".join(map(chr, (-piece[spelled] - 1).tolist())).encode()
            at = np.repeat(ends[spelled] - count[spelled], count[spelled])
            own = np.cumsum(count[spelled])
            at += np.arange(own[-1]) - np.repeat(own - count[spelled], count[spelled])
            ids[at] = self.v.bytes[np.frombuffer(data, np.uint8)]
        unit_ends = np.concatenate([[0], ends])[path.ends]
        cuts = np.concatenate([[0], unit_ends])
        return [ids[a:b] for a, b in zip(cuts[self.doc_starts].tolist(), cuts[self.doc_ends].tolist(), strict=True)]


def _below(mass: np.ndarray, most: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """Gumbel variables of log mass ``mass`` given that they are below ``most``."""
    with np.errstate(over="ignore", invalid="ignore"):
        value = mass - np.log(np.exp(np.minimum(mass - most, 700)) - np.log(uniform))
    return np.where(np.isfinite(mass), value, -np.inf)


def _unit_hashes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each unit's characters, one character of all units after the other."""
    out = mix(lengths.astype(np.uint64))
    active, n = np.arange(len(starts)), 0
    while len(active):
        out[active] = out[active] * _BASE + codes[starts[active] + n]
        n += 1
        active = active[lengths[active] > n]
    return mix(out)


def _sample(path: str, k: int, seed: int, decode: bool, size: int):
    def sample(batches):
        v = vocabulary(path)
        width = np.uint16 if v.size <= 1 << 16 else np.uint32
        for table in blocks(batches, size=size):
            ids = column(table, "doc_id")
            keys = np.array(
                [xxhash.xxh64_intdigest(str(i), seed) for i in ids.to_pylist()], np.uint64
            )
            sampler = Sampler(texts(table).to_pylist(), keys, v)
            found = list(sampler.search(k))
            threshold = found.pop()
            for number, (rows, log_prob, perturbed, drawn) in enumerate(found, 1):
                if not len(rows):
                    continue
                pieces = sampler.pieces(drawn)
                gap = np.exp(np.minimum(log_prob - threshold, 700))
                with np.errstate(divide="ignore"):
                    inclusion = np.where(gap < 1e-9, log_prob - threshold, np.log(-np.expm1(-gap)))
                columns = {
                    "doc_id": ids.take(pa.array(rows)),
                    "sample": pa.array(np.full(len(rows), number, np.int32)),
                    "n_pieces": pa.array([len(pieces[r]) for r in rows], pa.int64()),
                    "log_prob": log_prob[rows],
                    "perturbed": perturbed[rows],
                    "log_inclusion": inclusion[rows],
                    "pieces": pa.array([pieces[r].astype(width).tobytes() for r in rows], pa.binary()),
                }
                if decode:
                    columns["decoded"] = pa.array(decode_pieces([pieces[r] for r in rows], v), pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return sample


def sampled_segmentations(
    docs: DataFrame,
    model_path: str,
    k: int = 2,
    seed: int = SEED,
    decode: bool = False,
    block_bytes: int = BLOCK,
) -> DataFrame:
    """Up to ``k`` distinct segmentations of each row of ``docs(doc_id, text)``, best first.

    ``pieces`` holds the ids as little-endian numbers of two bytes (four for vocabularies
    above 65,536); ``log_prob`` is the segmentation's, ``perturbed`` its Gumbel value and
    ``log_inclusion`` the log probability of being among the k, given the k + 1st value.
    ``decode`` adds ``decoded``, the text that the pieces give again.
    ``block_bytes`` of text are searched at once; a task needs some 120 times as many bytes.
    ``model_path`` names a sentencepiece model on every machine.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = ROWS + ", decoded string" if decode else ROWS
    return docs.mapInArrow(_sample(model_path, k, seed, decode, block_bytes), rows)


def decode_pieces(pieces: list[np.ndarray], v: Vocabulary) -> list[str]:
    """The texts of lists of piece ids; bytes that are no character become U+FFFD."""
    if not pieces:
        return []
    ids = np.concatenate(pieces).astype(np.int32)
    length = v.pool_length[ids]
    ends = np.cumsum(length, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    source = np.repeat(v.pool_start[ids] - (ends - length), length) + np.arange(total)
    raw = v.pool[source].tobytes()
    text_ends = np.concatenate([[0], ends])[np.cumsum([len(p) for p in pieces])].tolist()
    cut = (raw[a:b] for a, b in zip([0, *text_ends[:-1]], text_ends, strict=True))
    return [text.removeprefix(b" ").decode("utf-8", "replace") for text in cut]


def decoded(pieces: Column, model_path: str) -> Column:
    """Decode a column of ``pieces``."""

    def decode(values: pa.Array) -> pa.Array:
        v = vocabulary(model_path)
        width = np.uint16 if v.size <= 1 << 16 else np.uint32
        given = [np.frombuffer(x or b"", width) for x in values.to_pylist()]
        return pa.array(decode_pieces(given, v), pa.string(), mask=values.is_null().to_numpy(False))

    return F.arrow_udf(decode, "string")(pieces)

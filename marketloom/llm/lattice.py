"""Sampled segmentations of texts into pieces: Gumbel top-k without replacement over the lattice.

The segmentations of a text form a lattice whose backward sums give the chance of every next piece. Each
segmentation has a Gumbel-perturbed log-probability, and the k largest are a sample without replacement. They are
found by best-first search over prefixes: a prefix's value is the largest below it, so the best prefix
always leads straight to the next sample, and only the prefixes that branch off it are new. Noise comes from
the row's key and the place in the text, so a row gets the same samples wherever and whenever it runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from marketloom.llm.common import keyed, mix, slices

SPACE = "▁"
FIRST_PIECE = 259
FIRST_BYTE = 3
TEMPERATURE = 1.0
UNKNOWN_PENALTY = 10.0
SAMPLES = 2
SLICE = 2 << 20
MOST_ARCS = 3_000_000
UNITS_TOGETHER = 4096
# Odd multipliers for hashing.
BASE = np.uint64(0x9E3779B97F4A7C15)
ROUND = np.uint64(0xD6E8FEB86659FD93)


class Pieces:
    """The pieces of a vocabulary file, and hash tables of them and of their prefixes.

    A piece's weight falls with its rank: the logarithm of 1 / (rank * normaliser), divided by ``temperature``.
    A character without a piece of its own is spelt in bytes, at the lowest weight less a penalty.
    """

    def __init__(self, path: str, temperature: float = TEMPERATURE):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        n = len(self.text)
        rank = np.maximum(np.arange(n) - FIRST_PIECE + 1, 1)
        self.weight = -np.log(rank * np.log(n)) / temperature
        self.unknown = float(self.weight.min()) - UNKNOWN_PENALTY
        self.spelling = [bytes([i - FIRST_BYTE]) if FIRST_BYTE <= i < FIRST_PIECE else p.replace(SPACE, " ").encode() for i, p in enumerate(self.text)]
        self.single = {p for p in self.text[FIRST_PIECE:] if len(p) == 1}
        self.longest = max(map(len, self.text[FIRST_PIECE:]))
        known: dict[int, int] = {}
        for i in range(FIRST_PIECE, n):
            value = 0
            for at, char in enumerate(self.text[i]):
                value = self.step(value, ord(char))
                known.setdefault(value, -1)
                if at == len(self.text[i]) - 1:
                    known[value] = i
        self.keys = np.array(sorted(known), np.uint64)
        self.ids = np.array([known[int(k)] for k in self.keys], np.int64)
        self.bits = 20
        slot = (mix(self.keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        self.keys, self.ids = self.keys[order], self.ids[order]
        self.bucket = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1))
        self.deepest = int(np.diff(self.bucket).max())
        self.sizes = np.array([len(s) for s in self.spelling])
        self.spelt = np.frombuffer(b"".join(self.spelling), np.uint8)
        self.spelt_at = np.concatenate(([0], np.cumsum(self.sizes)))

    @staticmethod
    def step(value: int, char: int) -> int:
        return ((value ^ (char + 1)) * int(BASE)) & 0xFFFFFFFFFFFFFFFF

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a piece starts with each hashed string, the piece it is or -1)."""
        slot = (mix(values) >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.bucket[slot], self.bucket[slot + 1]
        prefix, piece = np.zeros(len(values), bool), np.full(len(values), -1)
        for _ in range(self.deepest):
            here = np.flatnonzero(at < end)
            if not len(here):
                break
            same = self.keys[at[here]] == values[here]
            prefix[here[same]], piece[here[same]] = True, self.ids[at[here[same]]]
            at[here] = np.where(same, end[here], at[here] + 1)
        return prefix, piece

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of pieces: exact for texts without the space mark, bytes included."""
        size = self.sizes[ids]
        at = np.repeat(self.spelt_at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.spelt[at].tobytes()[1:]


class Lattice:
    """The arcs of distinct units, with the chance of each arc at its node.

    target: the node an arc leads to; name: its piece, or -1 - c for a character c without one; last: whether it
    ends its unit. Units can be added, so that words met before are not built again.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.number: dict[str, int] = {}
        self.met = np.zeros(0, np.int64)
        self.nodes, self.arcs = 0, 0
        self.first, self.start = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.target, self.name = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.log_chance, self.inverse_chance, self.last = np.zeros(0), np.zeros(0), np.zeros(0, bool)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The numbers of distinct units; those not known yet are added."""
        found = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(found < 0)
        found[missing] = len(self.number) + np.arange(len(missing))
        new = [units[i] for i in missing.tolist()]
        for at in range(0, len(new), UNITS_TOGETHER):
            self._add(new[at : at + UNITS_TOGETHER])
        self.met[found] += 1
        return found

    def _add(self, new: list[str]) -> None:
        known = len(self.number)
        self.number.update(zip(new, range(known, known + len(new)), strict=True))
        more = _Arcs(new, self.pieces)
        self.first = _put(self.first, known, more.first + self.nodes)
        self.start = _put(self.start, self.nodes, more.start + self.arcs)
        self.target = _put(self.target, self.arcs, more.target + self.nodes)
        self.name, self.last = _put(self.name, self.arcs, more.name), _put(self.last, self.arcs, more.last)
        self.log_chance = _put(self.log_chance, self.arcs, more.log_chance)
        self.inverse_chance = _put(self.inverse_chance, self.arcs, np.exp(-more.log_chance))
        self.met = _put(self.met, known, np.zeros(len(new), np.int64))
        self.nodes, self.arcs = self.nodes + int(more.first[-1]), self.arcs + len(more.target)

    def forget(self, most: int) -> None:
        """Drops the units that were asked for once; all units where the others have more than ``most`` arcs."""
        n = len(self.number)
        first = self.first[: n + 1]
        begin = self.start[first]
        keep = np.flatnonzero(self.met[:n] > 1)
        if np.diff(begin)[keep].sum() > most:
            keep = keep[:0]
        nodes, arcs = np.diff(first)[keep], np.diff(begin)[keep]
        node, arc = _spans(first[keep], nodes), _spans(begin[keep], arcs)
        degree = np.diff(self.start[: self.nodes + 1])[node]
        new_first = np.concatenate(([0], np.cumsum(nodes)))
        self.target = self.target[arc] + np.repeat(new_first[:-1] - first[keep], arcs)
        self.name, self.last, self.log_chance, self.inverse_chance = self.name[arc], self.last[arc], self.log_chance[arc], self.inverse_chance[arc]
        self.first, self.start = new_first, np.concatenate(([0], np.cumsum(degree)))
        self.nodes, self.arcs = len(node), len(arc)
        names = list(self.number)
        self.number = {names[i]: at for at, i in enumerate(keep.tolist())}
        self.met = np.ones(len(keep), np.int64)


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one range after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from ``at`` on; made twice as long where it is too short, so that few additions copy it."""
    end = at + len(values)
    if end > len(array):
        longer = np.empty(2 * end, array.dtype)
        longer[:at] = array[:at]
        array = longer
    array[at:end] = values
    return array


class _Arcs:
    """The arcs of some units, sorted by their nodes."""

    def __init__(self, units: list[str], pieces: Pieces):
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        n = len(chars)
        left = np.repeat(self.first[1:], sizes) - np.arange(n)
        source, target, name, weight, slot = [], [], [], [], []
        live = np.arange(n)
        value = np.zeros(n, np.uint64)
        alone = np.zeros(n, bool)
        degree = np.zeros(n, np.int64)

        def add(nodes: np.ndarray, length: int, names: np.ndarray, weights: np.ndarray) -> None:
            source.append(nodes)
            target.append(nodes + length)
            name.append(names)
            weight.append(weights)
            slot.append(degree[nodes])
            degree[nodes] += 1

        for length in range(1, pieces.longest + 1):
            live = live[left[live] >= length]
            if not len(live):
                break
            value[live] = (value[live] ^ (chars[live + length - 1] + np.uint64(1))) * BASE
            prefix, piece = pieces.find(value[live])
            found = np.flatnonzero(piece >= 0)
            piece = piece[found]
            add(live[found], length, piece, pieces.weight[piece])
            if length == 1:
                alone[live[found]] = True
            live = live[prefix]
        odd = np.flatnonzero(~alone)
        add(odd, 1, -1 - chars[odd].astype(np.int64), np.full(len(odd), pieces.unknown))
        source, target, name, weight, slot = map(np.concatenate, (source, target, name, weight, slot))
        self.start = np.concatenate(([0], np.cumsum(degree)))
        place = self.start[source] + slot
        self.target, self.name, self.last = np.empty_like(target), np.empty_like(name), np.empty(len(place), bool)
        self.target[place], self.name[place] = target, name
        ends = left[source] == target - source
        self.last[place] = ends
        self.log_chance = np.empty(len(place))
        self.log_chance[place] = self._chances(source, np.where(ends, n, target), weight, slot, left, degree)

    @staticmethod
    def _chances(source: np.ndarray, target: np.ndarray, weight: np.ndarray, slot: np.ndarray, left: np.ndarray, degree: np.ndarray) -> np.ndarray:
        """The log-chance of each arc at its node, from the ends of the units backwards; an arc to a unit's end has the target n."""
        n = len(left)
        by_left = np.argsort(left.astype(np.uint16) if n and left.max() < 1 << 16 else left, kind="stable")
        start = np.concatenate(([0], np.cumsum(degree[by_left])))
        begin = np.empty(n, np.int64)
        begin[by_left] = start[:-1]
        place = begin[source] + slot
        whole, ahead = np.empty(len(place)), np.empty(len(place), np.int64)
        whole[place], ahead[place] = weight, target
        total = np.zeros(n + 1)
        levels = np.flatnonzero(np.diff(left[by_left], prepend=0, append=-1)).tolist()
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            lo, hi = start[a], start[b]
            part = whole[lo:hi]
            part += total[ahead[lo:hi]]
            begins, width = start[a:b] - lo, degree[by_left[a:b]]
            top = np.maximum.reduceat(part, begins)
            sums = top + np.log(np.add.reduceat(np.exp(part - np.repeat(top, width)), begins))
            total[by_left[a:b]] = sums
            part -= np.repeat(sums, width)
        return whole[place]


def _clock(seed: np.ndarray) -> np.ndarray:
    """Exponential noise; the negative logarithm of it is Gumbel noise."""
    out = (mix(seed) >> np.uint64(11)).astype(np.float64)
    out += 0.5
    out /= 2.0**53
    return np.negative(np.log(out, out=out), out=out)


@dataclass
class Walk:
    """Paths of some texts, one after the other: arcs taken, and how far the next best arc of each step is behind.

    node, seed, unit: of each unit its first node, its noise and its number; first: where each unit's steps start, and
    the end; step: the same for texts; before: the log-probability ahead of each step; side_lag: infinite where
    a step has one arc only. A side's perturbed value is -log(exp(-value) + exp(lag)), with the value of the
    text's path.
    """

    node: np.ndarray
    seed: np.ndarray
    unit: np.ndarray
    first: np.ndarray
    arcs: np.ndarray
    step: np.ndarray
    before: np.ndarray
    side_lag: np.ndarray
    value: np.ndarray


def _rings(lattice: Lattice, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(arc, when its clock rings) of every arc of some nodes; where each node's arcs start, and how many they are."""
    begin = lattice.start[node]
    width = lattice.start[node + 1] - begin
    offset = np.cumsum(width) - width
    count = np.arange(width.sum())
    noise = np.repeat(seed - offset.astype(np.uint64), width)
    noise += count.view(np.uint64)
    arc = np.repeat(begin - offset, width)
    arc += count
    rings = _clock(noise)
    rings *= lattice.inverse_chance[arc]
    return arc, rings, offset, width


def walk(lattice: Lattice, node: np.ndarray, unit: np.ndarray, bounds: np.ndarray, seed: np.ndarray, value: np.ndarray, before: np.ndarray) -> Walk:
    """Follows each text's best path from the given nodes of its units to their ends.

    Of the arcs of a node the one whose clock rings first is taken; a clock is exponential noise over the arc's
    chance. bounds: where each text's units start; seed: noise of each unit; value: the perturbed value of each
    text's prefix, which the best path keeps; before: the prefix's log-probability.
    """
    active, here, depth = np.arange(len(node)), node, 0
    steps = np.zeros(len(node), np.int64)
    levels: list[tuple[np.ndarray, ...]] = []
    while len(active):
        chosen = lattice.start[here]
        fork = np.flatnonzero(lattice.start[here + 1] - chosen > 1)
        lags = np.zeros(0)
        if len(fork):
            arc, rings, offset, width = _rings(lattice, here[fork], seed[active[fork]] + np.uint64(depth << 20))
            least = np.minimum.reduceat(rings, offset)
            won = np.flatnonzero(rings == np.repeat(least, width))
            if len(won) > len(fork):
                won = won[np.diff(np.searchsorted(offset, won, "right"), prepend=0) != 0]
            chosen[fork] = arc[won]
            rings[won] = np.inf
            lags = np.minimum.reduceat(rings, offset) - least
        levels.append((active, chosen, fork, lags))
        steps[active] += 1
        going = ~lattice.last[chosen]
        here = lattice.target[chosen[going]]
        active = active[going]
        depth += 1
    first = np.concatenate(([0], np.cumsum(steps)))
    arcs, side_lag = np.empty(int(first[-1]), np.int64), np.full(int(first[-1]), np.inf)
    for depth, (active, chosen, fork, lags) in enumerate(levels):
        place = first[active] + depth
        arcs[place] = chosen
        side_lag[place[fork]] = lags
    step = first[bounds]
    running = np.concatenate(([0.0], np.cumsum(lattice.log_chance[arcs])))
    prior = running[:-1] + np.repeat(before - running[step[:-1]], np.diff(step))
    with np.errstate(divide="ignore"):
        np.log(side_lag, out=side_lag)
    side_lag -= prior
    return Walk(node, seed, unit, first, arcs, step, prior, side_lag, value)


def _units(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many units each text has, and all units: spaces and what follows them up to the next space.

    A text has a space mark put before it and marks for its spaces; an empty one has no units.
    """
    texts = texts.cast(pa.large_string())
    marked = pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), pc.replace_substring(texts, " ", SPACE), pa.scalar("", pa.large_string()))
    marked = pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), marked)
    at = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + len(marked) + 1] if len(marked) else np.zeros(1, np.int64)
    if at[0] == at[-1]:
        return np.zeros(len(texts), np.int64), pa.array([], pa.large_string())
    raw = np.frombuffer(marked.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    one, two, three = SPACE.encode()
    space = np.zeros(len(raw), bool)
    space[:-2] = (raw[:-2] == one) & (raw[1:-1] == two) & (raw[2:] == three)
    starts = space.copy()
    starts[3:] &= ~space[:-3]
    starts[at[:-1][at[:-1] < at[1:]]] = True
    where = np.flatnonzero(starts)
    buffers = [None, pa.py_buffer(np.append(where, len(raw))), pa.py_buffer(raw)]
    return np.diff(np.searchsorted(where, at)), pa.Array.from_buffers(pa.large_string(), len(where), buffers)


def sample(texts: list[str] | pa.Array, seeds: np.ndarray, lattice: Lattice, k: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to ``k`` distinct segmentations as (ids, log-probability, inclusion chance), best first.

    The inclusion chance is that of the sample's perturbed value to pass the best value not taken; it is one
    where all segmentations are taken.
    """
    counts, split = _units(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    coded = split.dictionary_encode()
    kinds = lattice.numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
    place = np.arange(len(kinds)) - np.repeat(bounds[:-1], counts)
    n = len(texts)
    root = -np.log(_clock(seeds))
    noise = mix(np.repeat(seeds, counts) + (place.astype(np.uint64) + np.uint64(1)) * BASE)
    first = walk(lattice, lattice.first[kinds], np.arange(len(kinds)), bounds, noise, root, np.zeros(n))
    # Of each walk, for each of its texts: the whole path it ends, and how many of its arcs came before the walk.
    walks = [first]
    paths = [[(first.arcs[a:b], 0) for a, b in zip(first.step[:-1].tolist(), first.step[1:].tolist(), strict=True)]]
    found = [[path] for path, _ in paths[0]]
    open_sides = _sides(lattice, first, 0, k, [[] for _ in range(n)])
    for round_ in range(1, k):
        going = [i for i in range(n) if open_sides[i]]
        if not going:
            break
        nodes, units, starts, values, befores, stems = [], [], [0], [], [], []
        for i in going:
            value, w, local, where, arc = open_sides[i].pop(0)
            source = walks[w]
            own = int(source.unit[np.searchsorted(source.first, where, "right") - 1])
            path, given = paths[w][local]
            stems.append(np.append(path[: given + where - int(source.step[local])], arc))
            rest = np.arange(own + 1, bounds[i + 1])
            inside = [] if lattice.last[arc] else [own]
            nodes.append(np.concatenate((lattice.target[[arc]] if inside else [], lattice.first[kinds[rest]])).astype(np.int64))
            units.append(np.concatenate((inside, rest)).astype(np.int64))
            starts.append(starts[-1] + len(rest) + len(inside))
            values.append(value)
            befores.append(source.before[where] + lattice.log_chance[arc])
        unit = np.concatenate(units)
        fresh = mix(noise[unit] + np.uint64(round_ * int(ROUND) % (1 << 64)))
        now = walk(lattice, np.concatenate(nodes), unit, np.array(starts), fresh, np.array(values), np.array(befores))
        walks.append(now)
        paths.append([])
        for j, (i, stem) in enumerate(zip(going, stems, strict=True)):
            path = np.concatenate((stem, now.arcs[now.step[j] : now.step[j + 1]]))
            paths[-1].append((path, len(stem)))
            found[i].append(path)
        for i, sides in zip(going, _sides(lattice, now, len(walks) - 1, k - round_, [open_sides[i] for i in going]), strict=True):
            open_sides[i] = sides
    out = []
    for mine, sides in zip(found, open_sides, strict=True):
        rows = []
        for path in mine:
            chance = float(lattice.log_chance[path].sum())
            include = float(-np.expm1(-np.exp(min(chance - sides[0][0], 50)))) if sides else 1.0
            rows.append((_ids(lattice.name[path]), chance, include))
        out.append(rows)
    return out


def _sides(lattice: Lattice, source: Walk, w: int, most: int, known: list[list[tuple]]) -> list[list[tuple[float, int, int, int, int]]]:
    """The ``most`` best open prefixes of each text as (value, walk, text in the walk, step, arc), best first.

    They branch off the ``most`` steps with the least lags; only these steps' arcs are looked at again.
    """
    picks = []
    for lo, hi in zip(source.step[:-1].tolist(), source.step[1:].tolist(), strict=True):
        lags = source.side_lag[lo:hi]
        top = np.argpartition(lags, most)[:most] if len(lags) > most else np.arange(len(lags))
        picks.append(lo + top[lags[top] < np.inf])
    step = np.concatenate([np.zeros(0, np.int64), *picks])
    text = np.repeat(np.arange(len(picks)), [len(p) for p in picks])
    if not len(step):
        return known
    own = np.searchsorted(source.first, step, "right") - 1
    depth = step - source.first[own]
    node = np.where(depth == 0, source.node[own], lattice.target[source.arcs[step - 1]])
    arc, rings, offset, width = _rings(lattice, node, source.seed[own] + (depth << 20).astype(np.uint64))
    other = arc != np.repeat(source.arcs[step], width)
    lag = (rings - np.repeat(np.minimum.reduceat(rings, offset), width))[other]
    text, step, arc = np.repeat(text, width)[other], np.repeat(step, width)[other], arc[other]
    lag = np.log(lag, out=np.full(len(lag), -np.inf), where=lag > 0) - source.before[step]
    values = (-np.logaddexp(-source.value[text], lag)).tolist()
    new = list(zip(values, [w] * len(values), text.tolist(), step.tolist(), arc.tolist(), strict=True))
    ends = np.searchsorted(text, np.arange(len(known) + 1)).tolist()
    return [sorted(mine + new[a:b], key=lambda x: (-x[0], x[1], x[3], x[4]))[:most] for mine, a, b in zip(known, ends[:-1], ends[1:], strict=True)]


def _ids(names: np.ndarray) -> np.ndarray:
    """Piece numbers; a character without a piece (a negative name) becomes the pieces of its UTF-8 bytes."""
    odd = np.flatnonzero(names < 0)
    if not len(odd):
        return names.astype(np.int32)
    sizes = np.ones(len(names), np.int64)
    spelt = "".join(map(chr, (-1 - names[odd]).tolist())).encode()
    lead = np.frombuffer(spelt, np.uint8)
    sizes[odd] = np.diff(np.append(np.flatnonzero((lead & 0xC0) != 0x80), len(lead)))
    out = np.repeat(names, sizes)
    out[out < 0] = FIRST_BYTE + lead.astype(np.int64)
    return out.astype(np.int32)


_LATTICES: dict[tuple[str, float], Lattice] = {}


def _lattice(path: str, temperature: float) -> Lattice:
    """This worker's lattice of the words met so far; when it has grown large, words met once are dropped."""
    known = _LATTICES.get((path, temperature))
    if known is None:
        known = _LATTICES[path, temperature] = Lattice(Pieces(path, temperature))
    if known.arcs > MOST_ARCS:
        known.forget(MOST_ARCS // 2)
    return known


def encode_samples(docs: DataFrame, model: str, k: int = SAMPLES, temperature: float = TEMPERATURE, with_ids: bool = True) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``: doc_id, sample (from 0, best first), n_pieces, log_prob, inclusion,
    ids_crc32, decodes, and with ``with_ids`` the ids.

    Segmentations of a row are distinct; a text with fewer than ``k`` has all of them, with inclusion one.
    Null and empty texts have one, without pieces. decodes tells whether the ids spell the text again
    (texts with the space mark itself do not). Rows with the same id and text get the same samples; an empty
    table gives none; other columns are ignored.
    """

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text"), SLICE):
                lattice = _lattice(model, temperature)
                pieces = lattice.pieces
                part = batch.slice(i, j - i)
                texts = part.column("text")
                k1, k2 = (np.asarray(part.column(c)).view(np.uint64) for c in ("k1", "k2"))
                rows = []
                for at, (raw, found) in enumerate(zip(texts.cast(pa.binary()).to_pylist(), sample(texts, mix(k1 ^ mix(k2)), lattice, k), strict=True)):
                    for number, (ids, chance, include) in enumerate(found):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((at, number, len(ids), chance, include, crc, pieces.decode(ids) == raw, ids if with_ids else None))
                at, *rest = zip(*rows, strict=True)
                types = (pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()))
                names = ["doc_id", "sample", "n_pieces", "log_prob", "inclusion", "ids_crc32", "decodes", "ids"]
                columns = [part.column("doc_id").take(pa.array(at)), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, sample int, n_pieces long, log_prob double, inclusion double, ids_crc32 long, decodes boolean, ids array<int>"
    out = keyed(docs).select("doc_id", "k1", "k2", "text").mapInArrow(sampled, schema)
    return out if with_ids else out.drop("ids")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` (doc_id, sample, ids) with the text that the ids spell: doc_id, sample, text. Null ids give null."""

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _lattice(model, TEMPERATURE).pieces
        for batch in batches:
            texts = [None if ids is None else pieces.decode(np.array(ids, np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("sample"), pa.array(texts, pa.string())], names=["doc_id", "sample", "text"])

    return rows.select("doc_id", "sample", "ids").mapInArrow(spelt, "doc_id long, sample int, text string")

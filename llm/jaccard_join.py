"""N-gram Jaccard join with prefix trees.

A document's set of word runs is held in one global order, that of the runs' hashes. Documents that may be linked
are dealt to the same task by an exact rule, and there the sets are stored in a trie that is walked with every
new set, sharing partial overlaps and leaving subtrees whose remaining lengths cannot reach the threshold. The trie
holds how each set differs from the runs that most sets of its family hold, which is little among near copies.

The rule: two sets with Jaccard at least r differ in at most D = (1-r)/(1+r) * (|x|+|y|) runs. Cut the order into
P > D segments; P - D segments at least are equal in both sets. A key is the content of a segment, so linked
documents share a key, while documents that have merely a passage in common do not, however frequent it is.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from llm.components import components
from tidymart.session import written

#: Keys that a map task combines at once, and runs that one trie holds at most (a larger set has its own).
KEYS_AT_ONCE = 2_000_000
RUNS_IN_TRIE = 2_000_000
#: Rows of a batch that a task hands over: a batch is held whole, outside the heap, where it arrives.
ROWS_IN_BATCH = 1 << 16
#: Buckets of runs whose texts are counted, to tell frequent runs; the flags that are broadcast take 128 KB.
BUCKETS = 1 << 20
_BUCKET_SHIFT = np.uint64(44)
_SLICES = 16


@dataclass(frozen=True)
class Threshold:
    """Runs of `n` words; documents link when `whole` * intersection >= `part` * union."""

    n: int = 5
    part: int = 80
    whole: int = 100

    def linked(self, overlap: int, a: int, b: int) -> bool:
        return self.whole * overlap >= self.part * (a + b - overlap)

    def largest_partner(self, size: int) -> int:
        return size * self.whole // self.part


class Scheme:
    """Size classes and the segments for each: sizes of linked sets are in the same class or in neighbouring ones.

    `frequent` flags buckets of runs that very many texts hold. A segment without any other run is weak: it
    tells little. A set with few weak segments agrees with its partners in one that isn't, so its weak ones
    are no keys; any flags give exact results, as long as all texts are keyed with the same.
    """

    def __init__(self, threshold: Threshold, frequent: np.ndarray | None = None):
        self.threshold = threshold
        self.frequent = frequent
        self.first = [1]
        self.segments: list[int] = []
        self.differ: list[int] = []
        self.crosses: list[bool] = []

    def extend(self, largest: int) -> None:
        t = self.threshold
        while self.first[-1] <= largest:
            # The partners of the class below end here, so no link skips a class.
            following = max(t.largest_partner(self.first[-1] - 1) + 1, self.first[-1] + 1)
            top = following - 1
            differ = (t.whole - t.part) * (top + t.largest_partner(top)) // (t.whole + t.part)
            self.differ.append(differ)
            self.segments.append(differ + 1 + (-(-differ // 10) + 2 if differ else 0))
            self.crosses.append(t.largest_partner(top) > top)
            self.first.append(following)

    def keys(self, values: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of sorted sets and the set of each: by the set's class, and by the class below for pairs across."""
        sizes = np.diff(total)
        self.extend(int(sizes.max(initial=0)) + 1)
        classes = np.searchsorted(np.array(self.first), sizes, "right") - 1
        owner = np.repeat(np.arange(len(sizes)), sizes)
        found = [self._class_keys(values, owner, sizes, classes, np.flatnonzero(sizes > 0))]
        lower = np.maximum(classes - 1, 0)
        across = (classes > 0) & np.array(self.crosses)[lower] & (sizes > 0)
        if across.any():
            use = across[owner]
            found.append(self._class_keys(values[use], owner[use], sizes, lower, np.flatnonzero(across)))
        return np.concatenate([k for k, _ in found]), np.concatenate([o for _, o in found])

    def _class_keys(self, values, owner, sizes, classes, sets):
        if not len(values):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        count = np.array(self.segments)[classes]
        segment = ((values >> np.uint64(32)) * count[owner].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(values), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        strong = np.ones(len(at), bool)
        if self.frequent is not None:
            rare = ~self.frequent[(values >> _BUCKET_SHIFT).astype(np.int64)]
            strong = np.add.reduceat(rare, at, dtype=np.int64) > 0
        sums = np.add.reduceat(words.mix(values), at)
        of, segment = owner[at], segment[at]
        # With so many weak or empty segments a set may agree in these alone: then they are keys, too.
        allowed = count - np.array(self.differ)[classes]
        weak = count - np.bincount(of[strong], minlength=len(sizes))
        use = strong | (weak >= allowed)[of]
        keys, owners = [self._key(sums[use], classes[of[use]], segment[use])], [of[use]]
        filled = np.bincount(of, minlength=len(sizes))
        for s in sets[(weak[sets] >= allowed[sets]) & (filled[sets] < count[sets])]:
            low, high = np.searchsorted(of, (s, s + 1))
            gone = np.setdiff1d(np.arange(count[s], dtype=np.uint64), segment[low:high])
            keys.append(self._key(np.zeros(len(gone), np.uint64), np.full(len(gone), classes[s]), gone))
            owners.append(np.full(len(gone), s))
        return np.concatenate(keys), np.concatenate(owners)

    @staticmethod
    def _key(sums, classes, segments):
        return words.mix(sums + words.mix(classes.astype(np.uint64) * np.uint64(1 << 32) + segments + np.uint64(1)))


def run_sets(column: pa.Array, n: int):
    """Chunks of texts: first row, sorted distinct runs of n words, and the number of runs before each text."""
    for a, _, data, starts in words.chunks(column):
        hashes, first = words.word_hashes(data, starts)
        yield a, *words.sorted_sets(*words.shingle_hashes(hashes, first, n))


_SETS = "doc_id long, size long, set_id long, slice int, counts binary"
_SLICE = BUCKETS // _SLICES


def identify(values: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set."""
    n = np.diff(total)
    sums = np.add.reduceat(np.append(words.mix(values), np.uint64(0)), total[:-1])
    return words.mix(np.where(n > 0, sums, np.uint64(0)) + n.astype(np.uint64)).view(np.int64)


def _set_batches(batches, threshold: Threshold):
    """Size and identity of each text's set; at the end of the task the texts that hold each bucket of runs, by slices."""
    buckets = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        sizes, identities = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, values, total in run_sets(batch.column(1), threshold.n):
            sizes.append(np.diff(total))
            identities.append(identify(values, total))
            buckets += np.bincount((values >> _BUCKET_SHIFT).astype(np.int64), minlength=BUCKETS)
        none = pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.binary())
        found = pa.array(np.concatenate(sizes)), pa.array(np.concatenate(identities))
        yield pa.RecordBatch.from_arrays([batch.column(0), *found, *none], [c.split()[0] for c in _SETS.split(", ")])
    if buckets.any():
        packed = [pa.compress(part.astype("<u4").tobytes(), codec="zstd", asbytes=True) for part in buckets.reshape(_SLICES, -1)]
        none = [pa.nulls(_SLICES, pa.int64())] * 3
        slices = pa.array(range(_SLICES), pa.int32()), pa.array(packed, pa.binary())
        yield pa.RecordBatch.from_arrays([*none, *slices], [c.split()[0] for c in _SETS.split(", ")])


def _bucket_sums(batches) -> dict[int, np.ndarray]:
    """Texts that hold each bucket, by slice."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(pa.decompress(counts, _SLICE * 4, codec="zstd", asbytes=True), "<u4")
            sums[number] = sums.get(number, 0) + part.astype(np.int64)
    return sums


def _flag_batches(batches, limit: float):
    """Buckets of each slice that more than `limit` texts hold, as bits."""
    sums = _bucket_sums(batches)
    flags = [np.packbits(s > limit).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(flags, pa.binary())], ["slice", "flags"])


def frequent_buckets(sets: DataFrame) -> np.ndarray:
    """Flags of the buckets that hold far more texts than chance puts there, counted over all texts."""
    total = sets.agg(F.sum("size")).first()[0] or 0
    mean = total / BUCKETS
    slices = sets.filter("slice is not null").select("slice", "counts").repartition(_SLICES, "slice")
    found = slices.mapInArrow(partial(_flag_batches, limit=mean + 4 * mean**0.5 + 32), "slice int, flags binary")
    flags = np.zeros((_SLICES, _SLICE), bool)
    for row in found.collect():  # `_SLICES` rows of a fixed size
        flags[row["slice"]] = np.unpackbits(np.frombuffer(row["flags"], np.uint8)).astype(bool)
    return flags.ravel()


def _level_batches(batches):
    """How frequent the buckets of each slice are, in eighths of a doubling."""
    sums = _bucket_sums(batches)
    levels = [np.minimum(8 * np.log2(s + 1), 255).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["slice", "levels"])


def bucket_levels(sets: DataFrame) -> np.ndarray:
    """A byte for each bucket that grows with the texts that hold it."""
    slices = sets.filter("slice is not null").select("slice", "counts").repartition(_SLICES, "slice")
    levels = np.zeros((_SLICES, _SLICE), np.uint8)
    for row in slices.mapInArrow(_level_batches, "slice int, levels binary").collect():  # `_SLICES` rows of a fixed size
        levels[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return levels.ravel()


_KEYED = "key long, set_id long"


def _keyed(keys, sets):
    """The rows in batches of a bounded size."""
    for i in range(0, len(keys), ROWS_IN_BATCH):
        part = slice(i, i + ROWS_IN_BATCH)
        yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(sets[part])], ["key", "set_id"])


def _combined(found: list[tuple[np.ndarray, np.ndarray]]):
    """One row per key of the task; sets that met here already are linked by a key of their own. The list is emptied."""
    keys, sets = (np.concatenate(c) for c in zip(*found, strict=True))
    found.clear()
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    del order
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    least = np.repeat(sets[at], np.diff(np.append(at, len(keys))))
    other = least != sets
    met = np.unique(np.stack([least[other], sets[other]], 1), axis=0)
    keys, sets = keys[at], sets[at]
    del least, other, new, at
    yield from _keyed(keys, sets)
    if len(met):
        a, b = met.T.copy()
        pair = words.mix(words.mix(a.view(np.uint64)) + b.view(np.uint64))
        yield from _keyed(np.concatenate((pair, pair)), np.concatenate((a, b)))


def _key_batches(batches, threshold: Threshold, frequent: np.ndarray):
    """Keys of all sets. Copies have the same set, so they meet nobody here."""
    scheme = Scheme(threshold, np.unpackbits(frequent).astype(bool))
    found, held = [], 0
    for batch in batches:
        for _, values, total in run_sets(batch.column(0), threshold.n):
            keys, owner = scheme.keys(values, total)
            found.append((keys, identify(values, total)[owner]))
            held += len(keys)
            if held >= KEYS_AT_ONCE:
                yield from _combined(found)
                held = 0
    if held:
        yield from _combined(found)


def rarest_runs(values: np.ndarray, total: np.ndarray, levels: np.ndarray, threshold: Threshold):
    """Each set's first runs in the order of levels and hashes, one more than a linked set may lack, and the set of each.

    The order is one for all sets, so two linked sets share one of these.
    """
    sizes = np.diff(total)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, levels[(values >> _BUCKET_SHIFT).astype(np.int64)], owner))
    first = sizes - -(-threshold.part * sizes // threshold.whole) + 1
    rank = np.arange(len(values)) - total[:-1][owner]
    return values[order[rank < first[owner]]], owner[rank < first[owner]]


def _rarest_batches(batches, threshold: Threshold, levels: np.ndarray):
    """The rarest runs of all sets as keys."""
    found, held = [], 0
    for batch in batches:
        for _, values, total in run_sets(batch.column(0), threshold.n):
            keys, owner = rarest_runs(values, np.asarray(total), levels, threshold)
            found.append((keys, identify(values, total)[owner]))
            held += len(keys)
            if held >= KEYS_AT_ONCE:
                yield from _combined(found)
                held = 0
    if held:
        yield from _combined(found)


def _meet_batches(batches):
    """Sets that share a key, from rows sorted by key: each with the least one."""
    last_key, last_set = None, None
    seen = np.zeros((0, 2), np.int64)
    for batch in batches:
        keys, sets = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        if last_key is not None:
            keys, sets = np.append(last_key, keys), np.append(last_set, sets)
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(sets, at), np.diff(np.append(at, len(keys))))
        met = np.stack([least, sets], 1)[least != sets]
        last_key, last_set = keys[-1:], least[-1:]
        if len(met):
            met = np.unique(met, axis=0)
            fresh = met[~_rows_in(met, seen)]
            if len(fresh):
                yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in fresh.T], ["a", "b"])
                seen = fresh if len(seen) > KEYS_AT_ONCE else np.concatenate((seen, fresh))


def _rows_in(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    pair = np.dtype([("a", np.int64), ("b", np.int64)])
    return np.isin(np.ascontiguousarray(rows).view(pair).ravel(), np.ascontiguousarray(others).view(pair).ravel())


_HEAD = 32  # runs of a node that are compared for all nodes of a step at once


class PrefixTree:
    """Joins sets one after another: `add` finds what the new set is linked with and stores it.

    `label` has the component of each set, by its links so far; subtrees of the new set's own component are skipped.

    A set may be given by how it differs from `common` runs, those that it lacks and those that it has besides. Two sets
    then overlap in `common`, less what each lacks, and as many as their differences share, so they are linked if
    (whole + part) * (common + shared) + slack + slack >= 0, with -(whole + part) * lacks - part * size as the slack of
    a set. Its gain is the slack with all of its difference shared.

    A node is a stretch of runs, the sets that end behind it, and its children. What decides on nodes is in arrays over
    all of them, so that a walk takes many at a step: the first runs, how many these are and the last of them, how many
    runs there are, the largest gain and slack of a set below, and a set below if all are in one component (-1 if not).
    """

    def __init__(self, threshold: Threshold, common: int = 0):
        self.threshold = threshold
        self.unit = threshold.whole + threshold.part
        self.common = common
        self.label, self.set_slack = np.zeros(16, np.int64), np.zeros(16, np.int64)
        self.mine = np.zeros(16, bool)
        self.count = 0
        self.links: list[tuple[int, int]] = []
        self.heads = np.zeros((16, _HEAD), np.int64)
        self.lengths, self.lasts, self.all, self.gain, self.slack, self.one = (np.zeros(16, np.int64) for _ in range(6))
        self.runs: list[np.ndarray] = []
        self.ends: list[list[int]] = []
        self.kids: list[array] = []
        self.places: list[dict[int, int]] = []
        self.root = self._node(np.zeros(0, np.int64), 0, 0, -1)

    def find(self, x: int) -> int:
        return int(self.label[x])

    def _unite(self, a: int, b: int) -> None:
        mine = self.label[: self.count]
        mine[mine == mine[b]] = mine[a]

    def add(self, runs: np.ndarray, known: int | None = None, size: int | None = None, lacks: int = 0) -> int:
        """`runs`: ascending small numbers. `known`: a set already in the tree that is linked with this one, directly or not.

        `size`: runs of the whole set, if `runs` is its difference, or leaves out what no other set of the tree has.
        """
        me = self.count
        if me == len(self.label):
            self.label, self.set_slack = (np.append(x, np.zeros(me, np.int64)) for x in (self.label, self.set_slack))
        self.count += 1
        self.label[me] = me if known is None else self.label[known]
        size = len(runs) if size is None else size
        self.set_slack[me] = -self.unit * lacks - self.threshold.part * size
        if size:
            runs = runs.astype(np.int64) + 1  # 0 is what pads the heads
            if len(runs) and runs[-1] >= len(self.mine):
                self.mine = np.zeros(2 * int(runs[-1]), bool)
            self.mine[runs] = True
            self._probe(me, runs)
            self.mine[runs] = False
            self._insert(me, runs)
        return me

    def _probe(self, me: int, runs: np.ndarray) -> None:
        self._link(me, [self.root], np.zeros(1, np.int64))
        # The latest children first: they are of sizes like this one's, so a link is found soon.
        end, step = len(self.kids[self.root]), 64
        while end:
            begin = max(0, end - step)
            nodes = np.array(np.frombuffer(self.kids[self.root], np.int64)[begin:end])
            overlap = seen = depth = np.zeros(len(nodes), np.int64)
            while len(nodes):
                nodes, overlap, seen, depth = self._step(me, runs, nodes, overlap, seen, depth)
            end, step = begin, 8 * step

    def _possible(self, me: int, nodes, overlap, left, depth):
        """Whether a set below each node can reach the threshold with what both have left."""
        least = -int(self.set_slack[me]) - self.unit * (self.common + overlap)
        return (self.gain[nodes] >= least + self.unit * depth) & (self.slack[nodes] >= least - self.unit * left)

    def _step(self, me, runs, nodes, overlap, seen, depth):
        """Compares the nodes with the set: overlap, runs seen and depth before them; the same of the children to go on with."""
        one = self.one[nodes]
        use = self._possible(me, nodes, overlap, len(runs) - seen, depth)
        use &= (one < 0) | (self.label[one] != self.label[me])
        nodes = nodes[use]
        overlap = overlap[use] + self.mine[self.heads[nodes]].sum(1)
        seen = np.searchsorted(runs, self.lasts[nodes], "right")
        depth = depth[use] + self.lengths[nodes]
        use = self._possible(me, nodes, overlap, len(runs) - seen, depth)
        nodes, overlap, seen, depth = nodes[use], overlap[use], seen[use], depth[use]
        long = np.flatnonzero(self.all[nodes] > self.lengths[nodes])
        if len(long):
            rest = [self.runs[node][_HEAD:] for node in nodes[long].tolist()]
            after = np.cumsum([len(r) for r in rest])
            rest = np.concatenate(rest)
            overlap[long] += np.add.reduceat(self.mine[rest], np.append(0, after[:-1]), dtype=np.int64)
            seen[long] = np.searchsorted(runs, rest[after - 1], "right")
            depth[long] += np.diff(after, prepend=0)
            use = self._possible(me, nodes, overlap, len(runs) - seen, depth)
            nodes, overlap, seen, depth = nodes[use], overlap[use], seen[use], depth[use]
        if not len(nodes):
            return nodes, overlap, seen, depth
        self._link(me, nodes.tolist(), overlap)
        kids = [np.frombuffer(self.kids[node], np.int64) for node in nodes.tolist()]
        many = [len(k) for k in kids]
        return np.concatenate(kids), np.repeat(overlap, many), np.repeat(seen, many), np.repeat(depth, many)

    def _link(self, me: int, nodes: list[int], overlap: np.ndarray) -> None:
        """Links with the sets that end behind the nodes."""
        ends = [self.ends[node] for node in nodes]
        others = np.array([x for e in ends for x in e], np.int64)
        overlap = np.repeat(overlap, [len(e) for e in ends])
        linked = self.set_slack[others] + self.set_slack[me] + self.unit * (self.common + overlap) >= 0
        for other in others[linked].tolist():
            if self.label[other] != self.label[me]:
                self.links.append((other, me))
                self._unite(other, me)

    def _node(self, runs: np.ndarray, gain: int, slack: int, one: int) -> int:
        """A new node; the arrays grow by doubling."""
        i = len(self.runs)
        if i == len(self.one):
            for name in ("heads", "lengths", "lasts", "all", "gain", "slack", "one"):
                was = getattr(self, name)
                setattr(self, name, np.concatenate((was, np.zeros_like(was))))
        self.gain[i], self.slack[i], self.one[i] = gain, slack, one
        self.runs.append(runs)
        self.ends.append([])
        self.kids.append(array("q"))
        self.places.append({})
        self._put(i, runs)
        return i

    def _put(self, i: int, runs: np.ndarray) -> None:
        head = runs[:_HEAD]
        self.runs[i] = runs
        self.heads[i] = 0
        self.heads[i, : len(head)] = head
        self.lengths[i], self.all[i] = len(head), len(runs)
        self.lasts[i] = head[-1] if len(head) else 0

    def _child(self, parent: int, child: int) -> None:
        self.places[parent][int(self.runs[child][0])] = child
        self.kids[parent].append(child)

    def _insert(self, me: int, runs: np.ndarray) -> None:
        size, at, node, slack = len(runs), 0, self.root, int(self.set_slack[me])
        gain = slack + self.unit * size
        while at < size:
            i = self.places[node].get(int(runs[at]))
            if i is None:
                i = self._node(runs[at:], gain, slack, me)
                self._child(node, i)
                node = i
                break
            stretch = self.runs[i]
            n = min(len(stretch), size - at)
            differ = np.flatnonzero(stretch[:n] != runs[at : at + n])
            n = int(differ[0]) if len(differ) else n
            if n < len(stretch):
                # The node keeps its first part; what follows, with all that is below, goes to a new one.
                low = self._node(stretch[n:], self.gain[i], self.slack[i], self.one[i])
                for part in (self.ends, self.kids, self.places):
                    part[i], part[low] = part[low], part[i]
                self._put(i, stretch[:n])
                self._child(i, low)
            if self.one[i] >= 0 and self.label[self.one[i]] != self.label[me]:
                self.one[i] = -1
            self.gain[i], self.slack[i] = max(self.gain[i], gain), max(self.slack[i], slack)
            at += n
            node = i
        self.ends[node].append(me)


def differences(sets: list[np.ndarray]) -> tuple[int, list[tuple[np.ndarray, int]]]:
    """The number of runs that more than half of the sets hold, and of each set how it differs from these and how many it lacks.

    Near copies hold nearly the same runs, so their differences are short. Runs are numbered, those in fewest
    differences first; what is in one difference only is left out, as no other set shares it.
    """
    total = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    distinct, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = 2 * count > len(sets)
    differ = np.where(common, len(sets) - count, count)
    number = np.empty(len(distinct), np.int64)
    number[np.argsort(differ, kind="stable")] = np.arange(len(distinct))
    shared = differ > 1
    base = np.flatnonzero(common)
    out = []
    for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True):
        mine = place[a:b]
        gone = np.delete(base, np.searchsorted(base, mine[common[mine]]))
        found = np.concatenate((mine[~common[mine]], gone))
        out.append((np.sort(number[found[shared[found]]]), len(gone)))
    return len(base), out


def likely_groups(sets: list[np.ndarray], threshold: Threshold) -> list[list[int]]:
    """Sets that may be linked, in groups with no link between them; sets that can't be linked are left out.

    Under any order two linked sets share one of their first runs, as many as a partner may lack and one more.
    Here the order is by how few of the sets hold a run, so these are a set's rarest runs: a passage that
    many share doesn't bring its documents together. Leaving sets out makes other runs rarer, so it is repeated.
    """
    left = [i for i, s in enumerate(sets) if len(s)]
    while left:
        runs = np.concatenate([sets[i] for i in left])
        total = np.concatenate(([0], np.cumsum([len(sets[i]) for i in left])))
        distinct, place, count = np.unique(runs, return_inverse=True, return_counts=True)
        shared, owners = [], []
        for k, i in enumerate(left):
            mine = place[total[k] : total[k + 1]]
            n = len(mine)
            first = n - -(-threshold.part * n // threshold.whole) + 1
            # Places ascend with the hashes, so this is one order for all sets.
            rarest = mine[np.lexsort((mine, count[mine]))[:first]]
            rarest = rarest[count[rarest] > 1]
            shared.append(rarest)
            owners.append(np.full(len(rarest), k))
        shared, owners = np.concatenate(shared), np.concatenate(owners)
        met = np.bincount(shared, minlength=len(distinct))
        useful = met[shared] > 1
        shared, owners = shared[useful], owners[useful]
        kept = np.unique(owners)
        if len(kept) == len(left):
            break
        left = [left[k] for k in kept]
    if not left:
        return []
    parent = list(range(len(left)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.argsort(shared, kind="stable")
    same = shared[order][1:] == shared[order][:-1]
    pairs = np.stack([owners[order][:-1][same], owners[order][1:][same]], 1)
    for a, b in np.unique(pairs, axis=0).tolist():
        parent[find(a)] = find(b)
    groups: dict[int, list[int]] = {}
    for k, i in enumerate(left):
        groups.setdefault(find(k), []).append(i)
    return list(groups.values())


def parted(sets: list[np.ndarray], threshold: Threshold) -> list[list[int]]:
    """Parts of a group with no link between them: families, each with the runs that most of its sets hold.

    The sets that hold most of a family's common runs leave the group if none of them can be linked with a set outside:
    it shares at most as many common runs as any outside has, and the runs besides that some other set holds, too.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    left, out = np.arange(len(sets)), []
    while len(left) > 2:
        count = np.bincount(place, minlength=len(distinct))
        held = np.bincount(place[np.isin(owner, owner[place == count.argmax()])], minlength=len(distinct))
        common = 2 * held > held.max()
        inside = np.bincount(owner[common[place]], minlength=len(sets))
        besides = np.bincount(owner[~common[place] & (count[place] > 1)], minlength=len(sets))
        family = 2 * inside > common.sum()
        mine, others = left[family[left]], left[~family[left]]
        if not len(others) or 16 * len(mine) < len(left):
            break
        if (threshold.whole * (inside[others].max() + besides[mine]) >= threshold.part * sizes[mine]).any():
            break
        out.append(mine.tolist())
        left = others
        keep = ~family[owner]
        owner, place = owner[keep], place[keep]
    return [*out, left.tolist()] if len(left) else out


def _own_batches(batches, threshold: Threshold):
    """The rows whose text has the set they name."""
    for batch in batches:
        named = batch.column("set_id").to_numpy()
        identities = [np.zeros(0, np.int64)]
        identities += [identify(values, total) for _, values, total in run_sets(batch.column("text"), threshold.n)]
        yield batch.filter(pa.array(np.concatenate(identities) == named))


def _join_cell(rows: pd.DataFrame, threshold: Threshold) -> pd.DataFrame:
    """Links between the sets of a cell, one at least for any two that links connect."""
    # Small sets first, and among equals those of one label together, so that order depends on no shuffle.
    rows = rows.sort_values(["size", "label", "set_id"], kind="stable").drop_duplicates("set_id")
    ids, labels = rows["set_id"].tolist(), rows["label"].tolist()
    sets = []
    for _, values, total in run_sets(pa.array(rows["text"], pa.string()), threshold.n):
        sets += [values[a:b] for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True)]
    links = []
    groups = likely_groups(sets, threshold)
    for group in [[group[k] for k in part] for group in groups for part in parted([sets[i] for i in group], threshold)]:
        common, differ = differences([sets[i] for i in group])
        tree = PrefixTree(threshold, common)
        first: dict[int, int] = {}
        for i, (runs, lacks) in zip(group, differ, strict=True):
            me = tree.add(runs, first.get(labels[i]), len(sets[i]), lacks)
            first.setdefault(labels[i], me)
        links += [(ids[group[a]], ids[group[b]]) for a, b in tree.links]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _cells(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Links found in each cell; `members`: (cell, set_id, size, label, text), cells of a bounded number of runs."""
    rows = members.select("cell", "set_id", "size", "label", "text")
    # What a cell takes is not told by its bytes: with a fixed number of partitions no small ones are put in one task.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell")
    return rows.groupBy("cell").applyInPandas(partial(_join_cell, threshold=threshold), "a long, b long")


def linked_components(docs: DataFrame, threshold: Threshold = Threshold(), id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, size, component_id) of every row: the distinct runs of its text, and the least id it reaches by links.

    The links are exact up to collisions of 64-bit hashes. A text without words, or null, has size 0 and is alone; one with fewer words than a run has
    its whole sequence as its only run. Rows that repeat an id are one document with each other's links; a null id has a
    null component; an empty table gives no rows; other columns are ignored.

    Only keys and ids are shuffled for all documents. Documents with equal sets are one class, of which the
    one with the least id goes on, so copies cost nothing further. The texts that go on are those that share a key with
    another class; they are written once. A class of candidates that is larger than a cell is parted by the rarest runs of
    its sets, and what is still larger is split in cells of bounded size: the first round joins each cell, the second
    joins what stayed apart from the largest component with every cell, in groups of bounded size. So no
    pair is missed and no task holds more than two cells.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    real = rows.filter("doc_id is not null")
    sets = written(rows.mapInArrow(partial(_set_batches, threshold=threshold), _SETS), "jaccard-sets")
    frequent = np.packbits(frequent_buckets(sets))
    keyed = real.select("text").mapInArrow(partial(_key_batches, threshold=threshold, frequent=frequent), _KEYED)
    met = keyed.repartition("key").sortWithinPartitions("key")
    blocks = components(met.mapInArrow(_meet_batches, "a long, b long"), "a", "b")

    everything = sets.filter("slice is null").select("doc_id", "size", "set_id")
    sizes = everything.filter("doc_id is not null")
    classes = written(sizes.filter("size > 0").groupBy("set_id", "size").agg(F.min("doc_id").alias("doc_id")), "jaccard-classes")
    members = blocks.join(classes, blocks["node"] == classes["set_id"])
    members = members.select("set_id", "doc_id", "size", F.col("component").alias("block"))
    totals = members.groupBy("block").agg(F.sum("size").alias("runs"), F.count("*").alias("n")).filter("n > 1")
    cells = F.ceil(F.col("runs") / F.lit(RUNS_IN_TRIE)).cast("long")
    members = members.join(totals.select("block", cells.alias("cells")), "block")
    members = written(members.withColumn("cell", F.col("block").cast("string")), "jaccard-members")
    # The few members are the side that is built, at every size.
    texts = real.join(members.hint("shuffle_hash"), "doc_id").select(*members.drop("doc_id").columns, "text")
    # An id may have other texts besides the one whose set is wanted.
    texts = written(texts.mapInArrow(partial(_own_batches, threshold=threshold), texts.schema), "jaccard-texts")
    large = not members.filter("cells > 1").isEmpty()
    if large:
        texts = texts.filter("cells <= 1").unionByName(_parted(texts.filter("cells > 1"), threshold))
    links = written(_cells(texts.withColumn("label", F.col("set_id")), threshold), "jaccard-links")
    if large:
        links = _across_cells(texts.filter("cells > 1"), links, threshold)
    # A class is linked with the documents that have its set.
    same = sizes.join(classes.select("set_id", "size", F.col("doc_id").alias("keeper")), ["set_id", "size"])
    same = written(same.select("doc_id", "keeper"), "jaccard-same")
    keepers = classes.select("set_id", "doc_id")
    links = links.join(keepers.toDF("a", "left"), "a").join(keepers.toDF("b", "right"), "b").select("left", "right")
    # An id with several sets links their classes.
    several = same.groupBy("doc_id").agg(F.min("keeper").alias("low"), F.max("keeper").alias("high")).filter("low < high")
    own = same.join(several, "doc_id", "left_semi").select("doc_id", "keeper").distinct()
    reached = components(written(links.union(own), "jaccard-document-links"), "left", "right")
    joined = same.join(reached, same["keeper"] == reached["node"], "left")
    found = joined.select("doc_id", F.coalesce("component", "keeper").alias("component_id"))
    found = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = everything.join(written(found, "jaccard-found"), "doc_id", "left")
    return out.select("doc_id", "size", F.coalesce("component_id", "doc_id").alias("component_id"))


def _parted(texts: DataFrame, threshold: Threshold) -> DataFrame:
    """The texts of large blocks in blocks of those that share rarest runs, and these in cells.

    A passage that many share is frequent, so it brings nobody together here; who meets nobody is left out.
    """
    levels = bucket_levels(written(texts.select("set_id", "text").mapInArrow(partial(_set_batches, threshold=threshold), _SETS), "jaccard-large"))
    keyed = texts.select("text").mapInArrow(partial(_rarest_batches, threshold=threshold, levels=levels), _KEYED)
    met = keyed.repartition("key").sortWithinPartitions("key")
    found = components(met.mapInArrow(_meet_batches, "a long, b long"), "a", "b")
    ids = texts.select("set_id", "size").distinct()
    members = ids.join(found, ids["set_id"] == found["node"]).select("set_id", "size", F.col("component").alias("block"))
    members = written(members, "jaccard-large-members")
    cells = F.ceil(F.sum("size") / F.lit(RUNS_IN_TRIE)).cast("long").alias("cells")
    members = members.join(members.groupBy("block").agg(cells), "block")
    part = F.pmod(F.xxhash64("set_id"), F.col("cells"))
    # The names differ from those of small blocks.
    members = members.withColumn("cell", F.concat_ws(":", "block", part))
    return written(members.join(texts.select("set_id", "text"), "set_id").select(*texts.columns), "jaccard-large-texts")


def _across_cells(texts: DataFrame, links: DataFrame, threshold: Threshold) -> DataFrame:
    """The links with those between cells of blocks that have several."""

    def labelled(links):
        found = components(links, "a", "b")
        ids = texts.select("set_id", "size", "block", "cell")
        joined = ids.join(found, ids["set_id"] == found["node"], "left")
        return written(joined.select(*ids.columns, F.coalesce("component", "set_id").alias("label")), "jaccard-labels")

    def joined_cells(rows, name):
        return written(_cells(rows.join(texts.select("set_id", "text"), "set_id"), threshold), name)

    now = labelled(links)
    # The least sets of large components of each cell meet first: at most 16 of each cell.
    large = now.groupBy("block", "cell", "label").agg(F.min("set_id").alias("set_id"), F.count("*").alias("n"))
    whole = now.groupBy("cell").agg(F.count("*").alias("all"))
    large = large.join(whole, "cell").filter("16 * n >= all").select("set_id")
    heads = written(now.join(large, "set_id", "left_semi"), "jaccard-large-heads")
    groups = heads.groupBy("block").agg(F.ceil(F.sum("size") / F.lit(RUNS_IN_TRIE)).cast("long").alias("groups"))
    group = F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("groups"))
    heads = heads.join(groups, "block").select(F.concat_ws(":", "block", group).alias("cell"), "set_id", "size", "label")
    links = links.union(joined_cells(heads, "jaccard-heads"))
    now = labelled(links)
    # What is not in a block's largest component meets every cell of the block, in guests' groups of a cell's size.
    counted = now.groupBy("block", "label").agg(F.count("*").alias("n"))
    largest = counted.groupBy("block").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    rest = now.join(largest, "block").filter("label <> largest")
    rest = written(rest.select("block", "set_id", "size", "label"), "jaccard-rest")
    groups = rest.groupBy("block").agg(F.ceil(F.sum("size") / F.lit(RUNS_IN_TRIE)).cast("long").alias("groups"))
    group = F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("groups"))
    columns = F.concat_ws("/", "cell", "group").alias("cell"), F.col("set_id"), F.col("size"), F.col("label")
    places = now.select("block", "cell").distinct()
    guests = rest.join(groups, "block").withColumn("group", group).join(places, "block").select(*columns)
    every = groups.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    hosts = now.join(every, "block").select(*columns)
    return links.union(joined_cells(hosts.union(guests).distinct(), "jaccard-all-links"))


def keep_one_of_each(docs: DataFrame, threshold: Threshold = Threshold(), id_column="doc_id", text_column="text") -> DataFrame:
    """The documents whose id is the least of their component, with all their columns; a null id stays.

    Rows that repeat such an id all stay.
    """
    found = linked_components(docs, threshold, id_column, text_column)
    gone = written(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "jaccard-gone")
    return docs.join(gone, docs[id_column] == gone["__gone"], "left_anti")

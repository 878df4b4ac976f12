"""Jaccard join on word shingles by T-occurrence search with DivideSkip.

Texts with the same shingle set form a class; one row of each class is searched for. Two classes of at least the similarity
asked for share one of their rarest shingles (the shortest n - T + 1 inverted lists of a set of n that must share T), so
these alone are dealt out by shingle, and tell which shards of the index a class has to be searched in. A shard holds the
whole sets of some classes as inverted lists; texts travel to it, as they take less room than sets. There a search merges its short lists, keeps the classes that
occur often enough for the long lists to make up the rest, and probes the long lists for them by binary search.
A shard passes over classes that it has already linked, so a group of near copies costs links in proportion to its size,
not its pairs; the links found connect the same documents as all links would.

Classes go to shards by their smallest shingle hash, which two similar sets share as often as they are similar, so that a class visits
few shards but its own; classes of one such hash beyond a shard's size are split over several, and the probes of a shard that many visit over several
copies of it. Postings of a frequent shingle are dealt
over as many tasks as its count asks for, and meet not each other but one summary for each shard that has the shingle.

Rarity is a count in a hashed table of fixed size over the whole corpus. It only orders the lists and tells which are split, so collisions cost
time, not results; a shingle stands out of the table's noise, the root of the mean count, once it is more frequent than that. Shingles are compared by
64-bit hashes and classes by 128 bits.

Words are split at ASCII white space, with A-Z in lower case. A text of fewer words than a shingle is one shingle. A text that
is null or without words has no set, links with nothing and is its own component; so is a row without an id. Repeated rows are a class like other
copies. Texts of any length are taken whole. Extra columns are ignored by join() and kept by one_of_each(), whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import join_large, left_join_large, materialise, maybe_member, parts

WORDS, SIMILARITY = 5, (80, 100)
#: Counters of the rarity table (4 bytes each), and how many a row of it holds.
COUNTERS, COUNTERS_A_ROW = 1 << 21, 1 << 14
#: Shingles of the classes whose sets a shard of the index holds.
SHARD_SHINGLES = 1 << 18
#: Probes of one shard that a task gets, or as many as the shard has classes if these are more; others go to copies of the shard.
PROBES = 512
#: Postings of one shingle that a task gets about; more are split.
HOT = 256
#: Weight of DivideSkip's estimate of how many long lists to pass over.
SKIP_WEIGHT = 0.0085
POSTING = ["token", "fp", "n", "after", "salts"]
#: Classes of a token that are compared one by one.
NEAR = 24


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(n: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTES, _PLACES = _random(256, 1), _random(4096, 2) | np.uint64(1)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _sum_of_products(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of values: their sum, each times the odd number of its place, mixed with the run's length."""
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(values)) - np.repeat(begin, lengths)
    factors = _PLACES if lengths.max() <= len(_PLACES) else _random(int(lengths.max()), 2) | np.uint64(1)
    return _mixed(np.add.reduceat(values * factors[place], begin) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sets_of(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text (UTF-8)."""
    texts = [t or b"" for t in texts]
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space, True]))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in texts]
    word = _sum_of_products(_BYTES[data[~space]], lengths)
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    shingle = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for i in range(words):
        shingle += word[i : len(word) - words + 1 + i] * _PLACES[i]
    shingle = _mixed(shingle + np.uint64(words * 0xD6E8FEB86659FD93 % 2**64))
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low >= words:
            own = np.sort(shingle[low : high - words + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        else:
            out.append(_sum_of_products(word[low:high], np.array([high - low])) if high > low else np.empty(0, np.uint64))
    return out


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in parts(batch):
        yield part, sets_of(part.column("text").cast(pa.binary()).to_pylist(), words)


def _class_of(own: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def required(n: int, similarity: tuple[int, int]) -> int:
    """Shingles that a set of n must share with any set that is no larger and similar enough."""
    return max(1, -(-n * similarity[0] // similarity[1]))


SCANNED = "key bigint, own bigint, n bigint, fp bigint, fp2 bigint, low bigint, part int, task int, counts binary"


def _scan(words: int):
    """Of each row its set's size, class and smallest hash; at the end the partition's rarity counts over distinct classes."""
    names = [f.split()[0] for f in SCANNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen = np.zeros(COUNTERS, np.uint32), set()
        for batch in batches:
            for part, sets in _sets(batch, words):
                rows = []
                for own in sets:
                    if not len(own):
                        rows.append((0, None, None, None))
                        continue
                    both = _class_of(own)
                    rows.append((len(own), *both, int(own[:1].view(np.int64)[0])))
                    if both not in seen:
                        seen.add(both)
                        counters[(own & np.uint64(COUNTERS - 1)).astype(np.int64)] += 1
                k = len(rows)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("own"), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)), *[pa.nulls(k, pa.int32())] * 2, pa.nulls(k, pa.binary())], names)
        if seen:
            packed = [zlib.compress(counters[i : i + COUNTERS_A_ROW].tobytes(), 1) for i in range(0, COUNTERS, COUNTERS_A_ROW)]
            k, task = len(packed), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([*[pa.nulls(k, pa.int64())] * 6, pa.array(range(k), pa.int32()), pa.array([task] * k, pa.int32()), pa.array(packed, pa.binary())], names)

    return run


def _rarity(counts: DataFrame) -> np.ndarray:
    """The rarity table of the corpus: partitions' counts are added in two steps. It has COUNTERS numbers for any input."""

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS_A_ROW, np.uint64)
        for row in group.column("counts"):
            total += np.frombuffer(zlib.decompress(row.as_py()), np.uint32)
        packed = zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([packed], pa.binary())})

    rows = counts.select("part", F.pmod("task", F.lit(64)).alias("slot"), "counts")
    some = rows.groupBy("part", "slot").applyInArrow(add, "part int, counts binary")
    out = np.zeros(COUNTERS, np.uint32)
    for row in some.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        out[row["part"] * COUNTERS_A_ROW :][:COUNTERS_A_ROW] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return out


def _salts(counts: np.ndarray, usual: float, hot: int) -> np.ndarray:
    """Over how many tasks the postings of shingles are dealt, by their counters; 0 for those that the usual counter may hide."""
    above = counts.astype(np.float64) - usual
    return np.where(above > hot + 8 * np.sqrt(usual), above // hot + 1, 0).astype(np.int32)


def _postings(sent, usual: float, words: int, similarity: tuple[int, int], hot: int):
    """(token, fp, n, after, salts) of the rarest shingles of each class that a partition holds.

    after counts the shingles of the set from this one on, in the order of rarity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = sent.value, set()
        for batch in batches:
            for _, sets in _sets(batch, words):
                columns = [[] for _ in POSTING]
                for own in sets:
                    if not len(own) or (both := _class_of(own)) in seen:
                        continue
                    seen.add(both)
                    keep = len(own) - required(len(own), similarity) + 1
                    counts = rarity[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    order = np.lexsort((own, counts))[:keep]
                    row = (own[order].view(np.int64), np.full(keep, both[0], np.int64), np.full(keep, len(own), np.int32), np.arange(len(own), len(own) - keep, -1, dtype=np.int32), _salts(counts[order], usual, hot))
                    for column, values in zip(columns, row, strict=True):
                        column.append(values)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], POSTING)

    return run


def _may_link(n, after, other_n, other_after, similarity: tuple[int, int]):
    """Whether sets can be similar enough if a shingle is the rarest that they share: no more than those from it on can be shared."""
    low, high = similarity
    least = -(-low * (n + other_n) // (low + high))
    return (after >= least) & (other_after >= least)


def _shared(similarity: tuple[int, int]):
    """Of postings sorted by token, size and class, those whose token has another class that they may link with.

    Neighbours up to NEAR rows away are compared; postings of tokens with more classes stay if the next by size fits. Postings of split tokens all stay.
    """
    low, high = similarity

    def kept(rows: list[np.ndarray]) -> pa.RecordBatch:
        new = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])]
        rows = [x[new] for x in rows]
        token, fp, n, after, salts = rows
        n, after = n.astype(np.int64), after.astype(np.int64)
        begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        many = np.repeat(np.diff(np.r_[begin, len(token)]), np.diff(np.r_[begin, len(token)])) > NEAR + 1
        keep = salts > 0
        for d in range(1, min(NEAR, len(token) - 1) + 1):
            may = (token[d:] == token[:-d]) & _may_link(n[:-d], after[:-d], n[d:], after[d:], similarity)
            if d == 1:
                may |= (token[1:] == token[:-1]) & many[1:] & (high * n[:-1] >= low * n[1:])
            keep[d:] |= may
            keep[:-d] |= may
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows], POSTING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in POSTING]
            if held is not None:
                rows = [np.r_[h, x] for h, x in zip(held, rows, strict=True)]
            last = int(np.argmax(rows[0] == rows[0][-1]))
            if last:
                yield kept([x[:last] for x in rows])
            held = [x[last:] for x in rows]
        if held is not None:
            yield kept(held)

    return run


def _routes(similarity: tuple[int, int]):
    """Of postings sorted by token, size and class: each class with the shards that hold earlier classes that it may link with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, before = None, {}
        low, high = similarity
        for batch in batches:
            probes, shards = [], []
            for token, n, after, fp, shard in zip(*(batch.column(c).to_pylist() for c in ("token", "n", "after", "fp", "shard")), strict=True):
                if token != current:
                    current, before = token, {}
                for other, seen in before.items():
                    if high * seen[-1][0] >= low * n and (len(seen) > NEAR or any(_may_link(n, after, *x, similarity) for x in seen)):
                        probes.append(fp)
                        shards.append(other)
                own = before.setdefault(shard, [])
                if len(own) > NEAR:  # then only the largest counts
                    own[-1] = (n, after)
                else:
                    own.append((n, after))
            yield pa.RecordBatch.from_arrays([pa.array(probes, pa.int64()), pa.array(shards, pa.int64())], ["fp", "shard"])

    return run


def _hot_routes(hot: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The same for postings of split tokens: a class meets one summary for each shard with its token, in one of the token's parts.

    Sets of similar enough sizes share at least n * similarity shingles, those from the token on among them.
    """
    low, high = similarity
    shards = hot.groupBy("token", F.col("shard").alias("to")).agg(F.min(F.struct("n", "fp")).alias("first"), F.max("n").alias("largest"), F.max("after").alias("most"), F.max("salts").alias("salts"))
    spread = shards.select("token", "to", "first", "largest", "most", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)).alias("salt"))
    met = hot.withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts").cast("long"))).join(spread, ["token", "salt"])
    may = (F.col("first") < F.struct("n", "fp")) & (F.least("largest", "after", "most") * high >= F.col("n") * low)
    return met.where(may).select("fp", F.col("to").alias("shard"))


class Shard:
    """Inverted lists of the sets of some classes (two numbers each), and what has been linked so far."""

    def __init__(self, ids: list[tuple[int, int]], sets: list[np.ndarray], similarity: tuple[int, int]):
        self.ids, self.similarity = np.array(ids, np.int64), similarity
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.tokens, rank = np.unique(np.concatenate(sets), return_inverse=True)
        # list and place in it as one sorted number, so that a binary search probes a list for a class
        self.entries = np.sort(rank.astype(np.int64) * len(ids) + np.repeat(np.arange(len(ids)), self.sizes))
        self.owners = self.entries % len(ids)
        self.begin = np.searchsorted(self.entries, np.arange(len(self.tokens) + 1) * len(ids))
        self.slots, self.used = {x: i for i, x in enumerate(ids)}, len(ids)
        self.up = np.arange(len(ids))

    def _slot(self, x: tuple[int, int]) -> int:
        """The place of a class in `up`; one that is not of the index gets the next."""
        if x not in self.slots:
            self.slots[x], self.used = self.used, self.used + 1
            if self.used > len(self.up):
                self.up = np.r_[self.up, np.arange(len(self.up), 2 * self.used)]
        return self.slots[x]

    def _roots(self, slots: np.ndarray) -> np.ndarray:
        """What stands for the linked group of each slot."""
        root = self.up[slots]
        while ((above := self.up[root]) != root).any():
            root = above
        self.up[slots] = root
        return root

    def search(self, probe: tuple[int, int], own: np.ndarray) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
        """Links from the probe to sets that come before it by size and class, but for those linked already."""
        low, high = self.similarity
        need, n = required(len(own), self.similarity), len(own)
        at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
        lists = at[self.tokens[at] == own]
        if len(lists) < need:
            return
        length = self.begin[lists + 1] - self.begin[lists]
        order = np.argsort(length, kind="stable")
        lists, length = lists[order], length[order]
        skipped = min(need - 1, int(need / (SKIP_WEIGHT * np.log2(length[-1] + 1) + 1)))
        short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
        spans = length[: len(short)]
        flat = np.repeat(self.begin[short] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())
        # the merge of the short lists: counted where they are long together, as in a group of near copies, and sorted otherwise
        if len(flat) > len(self.ids):
            all_times = np.bincount(self.owners[flat], minlength=len(self.ids))
            found = np.flatnonzero(all_times)
            times = all_times[found]
        else:
            found, times = np.unique(self.owners[flat], return_counts=True)
        one, two = self.ids[found].T
        before = (self.sizes[found] < n) | (self.sizes[found] == n) & ((one < probe[0]) | (one == probe[0]) & (two < probe[1]))
        keep = (times >= need - skipped) & before & (high * self.sizes[found] >= low * n)
        found, times = found[keep], times[keep]
        order = np.argsort(-times, kind="stable")
        found, times = found[order], times[order]
        mine, theirs = int(self._roots(np.array([self._slot(probe)]))[0]), self._roots(found)
        left = theirs != mine
        while left.any():
            i = int(np.argmax(left))
            left[i] = False
            key = long * len(self.ids) + found[i]
            place = np.minimum(np.searchsorted(self.entries, key), len(self.entries) - 1)
            overlap = int(times[i] + (self.entries[place] == key).sum())
            if high * overlap >= low * (n + int(self.sizes[found[i]]) - overlap):
                root = int(theirs[i])
                self.up[max(mine, root)] = mine = min(mine, root)
                left &= theirs != root
                yield probe, tuple(self.ids[found[i]].tolist())


CLASS = "struct<one:bigint,two:bigint>"


def _search(words: int, similarity: tuple[int, int]):
    """Of rows sorted by shard and copy, the texts of its index first: the links that searches of its probes find."""

    def classes(values: list[tuple[int, int]]) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array([x[i] for x in values], pa.int64()) for i in (0, 1)], ["one", "two"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index, ids, sets = None, None, [], []
        for batch in batches:
            links = []
            for part, found in _sets(batch, words):
                for *shard, probing, fp, own in zip(*(part.column(c).to_pylist() for c in ("shard", "copy", "probing", "fp")), found, strict=True):
                    if shard != current:
                        current, index, ids, sets = shard, None, [], []
                    if not len(own) or (both := _class_of(own))[0] != fp:
                        continue  # another text of a repeated id
                    if not probing:
                        ids.append(both)
                        sets.append(own)
                    elif ids:
                        index = index or Shard(ids, sets, similarity)
                        links += index.search(both, own)
            yield pa.RecordBatch.from_arrays([classes([x[i] for x in links]) for i in (0, 1)], ["u", "v"])

    return run


def _placed(active: DataFrame) -> tuple[DataFrame, int]:
    """Classes (fp, rep, n, low) with the shard of their smallest hash, or one of several where that has too many; and the number of shards."""
    total = active.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_SHINGLES))
    large = active.groupBy("low").agg(F.sum("n").alias("size")).where(F.col("size") > SHARD_SHINGLES)
    split = F.xxhash64("low", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / SHARD_SHINGLES)))
    shard = F.when(F.col("size").isNull(), F.pmod(F.xxhash64("low"), F.lit(shards))).otherwise(split)
    return materialise(active.join(large, "low", "left").select("fp", "rep", shard.alias("shard")), "placed"), shards


def links(docs: DataFrame, classes: DataFrame, rarity: np.ndarray, words: int, similarity: tuple[int, int]) -> DataFrame:
    """(u, v): links between classes, enough of them to connect all that all links connect."""
    sent = docs.sparkSession.sparkContext.broadcast(rarity)
    postings = docs.select("text").mapInArrow(_postings(sent, float(np.median(rarity)), words, similarity, HOT), "token bigint, fp bigint, n int, after int, salts int")
    part = F.when(F.col("salts") > 0, F.pmod("fp", F.col("salts").cast("long"))).otherwise(0)
    shared = materialise(postings.repartition("token", part).sortWithinPartitions("token", "n", "fp").mapInArrow(_shared(similarity), "token bigint, fp bigint, n int, after int, salts int"), "shared")
    active = materialise(classes.join(shared.select("fp").distinct(), "fp").select("fp", "rep", "n", "low"), "active")
    placed, shards = _placed(active)
    listed = shared.join(placed, "fp").select("token", "n", "after", "salts", "fp", "shard")
    routes = listed.where("salts = 0").repartition("token").sortWithinPartitions("token", "n", "fp").mapInArrow(_routes(similarity), "fp bigint, shard bigint")
    routes = materialise(routes.unionByName(_hot_routes(listed.where("salts > 0"), similarity)).distinct(), "routes")
    held = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    copies = F.ceil(F.col("size") / F.greatest(F.lit(PROBES), "held")).alias("copies")
    visited = routes.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).join(held, "shard").select("shard", "size", copies)
    to = F.struct("shard", F.pmod(F.xxhash64("fp"), F.col("copies")).alias("copy"), F.lit(True).alias("probing"))
    visits = join_large(routes, visited, ["shard"], routes.count()).groupBy("fp").agg(F.collect_list(to).alias("visits"))
    # a shard that holds a large share of the classes meets them by broadcast
    searched = visited.drop("size").join(held.withColumnRenamed("held", "size"), "shard")
    placed = left_join_large(placed, searched, ["shard"], active.count()).drop("size")
    texts, _ = maybe_member(docs.select(F.col("key").alias("rep"), "text"), "rep", active, active.count())
    texts = texts.join(placed.join(visits, "fp", "left"), "rep")
    own = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1).cast("long")) - 1), lambda c: F.struct("shard", c.alias("copy"), F.lit(False).alias("probing")))
    others = F.coalesce("visits", F.array().cast("array<struct<shard:bigint,copy:bigint,probing:boolean>>"))
    met = texts.select("fp", "text", F.explode(F.concat(own, others)).alias("to")).select("to.*", "fp", "text")
    return met.repartition(shards, "shard", "copy").sortWithinPartitions("shard", "copy", "probing").mapInArrow(_search(words, similarity), f"u {CLASS}, v {CLASS}")


def _components(docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """(key, own, n, component_id, root) of rows (key, own, text); own goes along, root tells components apart that share an id."""
    if not 0 < similarity[0] <= similarity[1] or words < 1:
        raise ValueError("similarity must be a share above 0, and shingles need a word")
    scanned = materialise(docs.mapInArrow(_scan(words), SCANNED), "scanned")
    rows = scanned.where("part is null")
    rarity = _rarity(scanned.where("part is not null"))
    has_class = F.coalesce(F.expr("n > 0 and key is not null"), F.lit(False))
    classes = rows.where(has_class).groupBy("fp", "fp2").agg(F.min("key").alias("rep"), F.max("n").alias("n"), F.max("low").alias("low"), F.count(F.lit(1)).alias("size"))
    classes = materialise(classes, "classes")
    found = connected_components(materialise(links(docs, classes, rarity, words, similarity), "links")).select("node.one", "node.two", F.xxhash64("component").alias("root"))
    linked = materialise(classes.join(found, (F.col("fp") == F.col("one")) & (F.col("fp2") == F.col("two"))).select("fp", "fp2", "rep", "root"), "linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("size"))
    linked = join_large(linked.drop("rep"), least, ["root"], linked.count()).drop("size")
    named = classes.select("fp", "fp2", "rep", "size").join(linked, ["fp", "fp2"], "left")
    root = F.coalesce("root", F.xxhash64(F.struct("fp", "fp2"))).alias("root")
    named = materialise(named.select("fp", "fp2", F.coalesce("component_id", "rep").alias("component_id"), root, "size"), "named")
    alone = rows.where(~has_class).select("key", "own", "n", F.col("key").alias("component_id"), F.lit(None).cast("long").alias("root"))
    classed = join_large(rows.where(has_class).select("key", "own", "n", "fp", "fp2"), named, ["fp", "fp2"], rows.count())
    return classed.select(alone.columns).unionByName(alone)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(id, n_shingles, component_id) of every row; ids are whole numbers.

    component_id is the smallest id that links reach; similarity is a percentage as (low, 100).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.lit(0).cast("long").alias("own"), F.col(text_col).alias("text"))
    return _components(rows, words, similarity).select(F.col("key").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row of docs of each component, that of the smallest id, by rows, not ids; all rows without a set or an id stay.

    Of several texts of that id in one component the one with the smallest hash stays, of repeated rows one.
    """
    key, own = F.col(id_col).cast("long").alias("key"), F.xxhash64(text_col).alias("own")
    rows = materialise(_components(docs.select(key, own, F.col(text_col).alias("text")), words, similarity).where("n > 0 and key is not null"), "components")
    heads = rows.where("key = component_id").groupBy("key", "root", "own").agg(F.count(F.lit(1)).alias("times"))
    firsts = heads.groupBy("key", "root").agg(F.min("own").alias("own"))
    others = heads.join(firsts, ["key", "root", "own"], "left_anti").select("key", "own")
    dropped = materialise(rows.where("key <> component_id").select("key", "own").distinct().unionByName(others), "dropped")
    tagged = docs.select(F.struct("*").alias("row"), key, own).join(dropped, ["key", "own"], "left_anti")
    again = materialise(heads.where("times > 1").join(firsts, ["key", "root", "own"]).select("key", "own"), "again")
    if again.isEmpty():
        return tagged.select("row.*")
    once = tagged.join(again, ["key", "own"], "left_semi").groupBy("key", "own").agg(F.first("row").alias("row"))
    return tagged.join(again, ["key", "own"], "left_anti").select("row.*").unionByName(once.select("row.*"))

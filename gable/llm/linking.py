"""From candidate tiles of sets to verified links, link counts and components.

A *tile* is a name (a long) shared by sets that may link; who makes the names
decides which links can be found. Sets are those of :mod:`shingles`; texts of
equal sets form a class. The steps, all over Spark tables:

1. :func:`profile`: size, class and bitmap of every row, and a fixed table of
   counts (hits of elements or names by hash cell) that tells common names.
2. :func:`link`: names that a common cell may make large are dealt over
   several partitions by class, so that no partition holds one hot tile.
   Tiles of a few classes give their pairs; larger ones become groups. A tile
   is merged with the others whose members mostly have the same largest tile,
   if comparing the union is no more work than comparing the tiles.
3. A pair that reaches the bound of two bitmaps is checked by intersecting the
   sorted arrays. Groups are cut into bands of set size and blocks of bounded
   bytes; only blocks whose sizes can meet are compared, each two of them in
   one task, by bitmaps first and then by the arrays of those that may link. A
   pair is checked in the first group both are in, else as a pair.
4. Link counts are summed, and components found over all links.

Nothing is capped or sampled. Arrays are made again from the texts of the
classes that are in pairs or groups; the others are told by a bit set of
bounded size, so texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.llm.common import Shared, discard, materialise, runs
from gable.llm.components import components
from gable.llm.shingles import bitmap, differing_bits, digest, shingle_sets

Tiles = Callable[[np.ndarray], np.ndarray]

_PIECE = 1 << 20  # bytes of text turned to sets at once
_BLOCK_ROWS, _BLOCK_ELEMENTS = 1024, 1 << 19


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, key): the key tells rows of different id or text apart."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Pieces of a batch of texts with their sets, a bounded number of bytes at a time."""
    texts = batch.column("text")
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    for a, b in runs(sizes, _PIECE):
        yield batch.slice(a, b - a), shingle_sets(texts.slice(a, b - a).to_pylist(), n)


# --- bit sets of keys ------------------------------------------------------

class KeySet:
    """A broadcast bit set of longs: never misses one, of others about one in 32 passes.

    It has 32 bits a key, ``most`` at the most (32 MB); with more keys than that
    more others pass, so every use checks again exactly.
    """

    def __init__(self, keys: DataFrame, most: int = 1 << 28):
        count = keys.count()
        self.bits = 1 << 16
        while self.bits < min(most, 32 * count):
            self.bits *= 2
        at = F.pmod(F.col(keys.columns[0]), F.lit(self.bits))
        bit = F.expr(f"shiftleft(1L, cast(pmod({keys.columns[0]}, {self.bits}) & 63 as int))")
        words = keys.select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
        found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        held = np.zeros(self.bits // 64, dtype=np.int64)
        held[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        self._held = Shared(keys.sparkSession, held)

    def mask(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.int64(self.bits - 1)
        return (self._held.value[at >> 6] >> (at & 63)) & 1 == 1

    def may_hold(self, key):
        """A boolean column: False where the key is surely not held."""
        @F.arrow_udf("boolean")
        def held(keys: pa.Array) -> pa.Array:
            return pa.array(self.mask(keys.to_numpy(zero_copy_only=False).astype(np.int64)))

        return held(key)


# --- step 1 ----------------------------------------------------------------

class Cells:
    """Counts by hash cell: an order of names from rare to common, and the names that may make a large tile."""

    def __init__(self, counts: np.ndarray, tile_rows: int = 4096):
        self.counts, self.limit = counts, max(tile_rows, int(4 * counts.mean()))

    def of(self, names: np.ndarray) -> np.ndarray:
        return self.counts[_cells(names, len(self.counts))]

    def parts(self, names: np.ndarray, row: int | np.ndarray) -> np.ndarray:
        """0 for a name of few rows; else one of as many parts as bound a part's rows."""
        hits = self.of(names)
        return np.where(hits > self.limit, 1 + (row & 0xFFFFFF) % np.maximum(1, -(-hits // self.limit)), 0)


def _cells(names: np.ndarray, cells: int) -> np.ndarray:
    return ((names >> np.uint64(20)) % np.uint64(cells)).astype(np.int64)


def _profile(texts: DataFrame, n: int, salt: int, tiles: Tiles | None, cells: int, counted_names: int | None) -> DataFrame:
    schema = ("doc_id long, key long, n_shingles long, class long, proof long, bits binary, tiles array<long>, "
              "cell int, hits long")

    def profile(batches):
        seen, hits = set(), np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for rows, sets in _sets(batch, n):
                known = [digest(s, salt) if len(s) else (None, None) for s in sets]
                maps, names, counted = [], [], [np.empty(0, np.uint64)]
                for s, (c, _) in zip(sets, known):
                    new = c is not None and c not in seen  # copies of a text cost one list a task
                    seen.add(c)
                    maps.append(bitmap(s).tobytes() if new else None)
                    named = s if new else None
                    if new and tiles:
                        named = tiles(s)
                    names.append(named.view(np.int64) if new and tiles else None)
                    if new:
                        counted.append(named[:counted_names] if tiles else named)
                hits += np.bincount(_cells(np.concatenate(counted), cells), minlength=cells)
                size = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([c for c, _ in known], pa.int64()), pa.array([p for _, p in known], pa.int64()),
                     pa.array(maps, pa.binary()), pa.array(names, pa.list_(pa.int64())),
                     pa.nulls(size, pa.int32()), pa.nulls(size, pa.int64())],
                    names=["doc_id", "key", "n_shingles", "class", "proof", "bits", "tiles", "cell", "hits"])
        used = np.flatnonzero(hits)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, none, pa.nulls(len(used), pa.binary()), pa.nulls(len(used), pa.list_(pa.int64())),
             pa.array(used, pa.int32()), pa.array(hits[used])],
            names=["doc_id", "key", "n_shingles", "class", "proof", "bits", "tiles", "cell", "hits"])

    return texts.mapInArrow(profile, schema)


class Profile:
    """Rows (doc_id, key, n_shingles, class), classes (class, n, copies, least doc_id, key, bits) and cells of texts.

    A class is named by 64 bits of its set's hash; 64 more prove that no two
    sets share a name, else the names are salted anew. Of the names that
    ``tiles`` makes, the first ``counted`` (None: all) are counted by cell and name tiles.
    Names of more than about ``tile_rows`` rows are dealt over several partitions.
    """

    def __init__(self, texts: DataFrame, n: int, tiles: Tiles | None = None, cells: int = 1 << 16,
                 counted: int | None = None, tile_rows: int = 4096):
        self.texts, self.n, self.salt, self.counted = texts, n, 0, counted
        while True:
            self.table = materialise(_profile(texts, n, self.salt, tiles, cells, counted))
            self.rows = self.table.where("cell is null").select("doc_id", "key", "n_shingles", "class", "tiles")
            self.classes = materialise(self.table.where("class is not null").groupBy("class").agg(
                F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"),
                F.min("key").alias("key"), F.max("bits").alias("bits"), F.min("proof").alias("lo"), F.max("proof").alias("hi")))
            if not self.classes.where("lo != hi").take(1):
                break
            discard(self.table, self.classes)
            self.salt += 1
        counts = np.zeros(cells, dtype=np.int64)
        hits = self.table.where("cell is not null").groupBy("cell").agg(F.sum("hits").alias("hits")).toArrow()
        counts[hits.column("cell").to_numpy()] = hits.column("hits").to_numpy()
        self.cells = Shared(texts.sparkSession, Cells(counts, tile_rows))

    def named(self, tiles: Callable[[np.ndarray, Cells], np.ndarray]) -> DataFrame:
        """(tile, part, class) from the texts again, names by a function of a set and the cells."""
        n, salt, cells = self.n, self.salt, self.cells

        def name(batches):
            seen = set()
            for batch in batches:
                for _, sets in _sets(batch, n):
                    out, of = [np.empty(0, np.uint64)], []
                    parts = [np.empty(0, np.int64)]
                    for s in sets:
                        c = digest(s, salt)[0] if len(s) else None
                        if c is None or c in seen:
                            continue
                        seen.add(c)
                        names = tiles(s, cells.value)
                        out.append(names)
                        parts.append(cells.value.parts(names, c))
                        of.append((c, len(names)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(parts).astype(np.int32)),
                         pa.array(np.repeat(np.array([c for c, _ in of], np.int64), [k for _, k in of]))],
                        names=["tile", "part", "class"])

        return self.texts.select("text").mapInArrow(name, "tile long, part int, class long")

    def stored(self) -> DataFrame:
        """(tile, part, class, rest) of the counted names that the profile holds; rest: the class's other names."""
        cells, counted = self.cells, self.counted

        def deal(batches):
            for batch in batches:
                lists = batch.column("tiles")
                named = pa.compute.list_value_length(lists).to_numpy() > 0
                of = batch.column("class").to_numpy()[named]
                if not len(of):
                    continue
                names = lists.flatten().to_numpy().view(np.uint64).reshape(len(of), -1)
                first = names[:, :counted].ravel()
                rows = np.repeat(np.arange(len(of)), len(first) // len(of))
                rest = pa.array([r.tobytes() for r in names[:, counted:]], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(cells.value.parts(first, of[rows]).astype(np.int32)),
                     pa.array(of[rows]), rest.take(pa.array(rows))], names=["tile", "part", "class", "rest"])

        return self.rows.where("tiles is not null").select("tiles", "class").mapInArrow(
            deal, "tile long, part int, class long, rest binary")

    def arrays(self, wanted: DataFrame) -> DataFrame:
        """(class, elements) of the wanted classes, from the texts again."""
        n, salt = self.n, self.salt
        wanted = materialise(wanted.join(self.classes.select("class", "key"), "class").select("class", "key"))
        keys = KeySet(wanted.select("key"))

        def arrays(batches):
            seen = set()
            for whole in batches:
                kept = whole.filter(pa.array(keys.mask(whole.column("key").to_numpy())))
                for rows, sets in _sets(kept, n):
                    new = []
                    for key, s in zip(rows.column("key").to_pylist(), sets):
                        c = digest(s, salt)[0] if len(s) else None
                        if c is not None and (c, key) not in seen:
                            seen.add((c, key))
                            new.append((c, key, s.tobytes()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c for c, _, _ in new], pa.int64()), pa.array([k for _, k, _ in new], pa.int64()),
                         pa.array([e for _, _, e in new], pa.binary())], names=["class", "key", "elements"])

        # what the bit set let pass beside the wanted keys goes with the join
        found = materialise(self.texts.select("text", "key").mapInArrow(arrays, "class long, key long, elements binary"))
        out = found.join(wanted, ["class", "key"]).select("class", "elements")
        out._step = found._step
        if found.select("class", "key").join(wanted, ["class", "key"]).count() > wanted.count():  # repeated rows
            out = materialise(out.dropDuplicates(["class"]))
            discard(found)
        return out


# --- step 2: tiles, pairs and groups ---------------------------------------

def tile_rows(tile, a, b=None) -> pa.RecordBatch:
    """Pairs (a, b) of a tile, or its members a."""
    return pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), pa.array(a, pa.int64()),
                                       pa.array(b, pa.int64()) if b is not None else pa.nulls(len(a), pa.int64())],
                                      names=["tile", "a", "b"])


def whole_tiles(batches: Iterator[pa.RecordBatch], width: int = 0) -> Iterator[list[np.ndarray]]:
    """[tile, part, class, and rest if of a width] without repeats, some whole (tile, part) at a time, from rows sorted so."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        come = [batch.column(c).to_numpy() for c in ("tile", "part", "class")]
        if width:
            come.append(np.frombuffer(b"".join(batch.column("rest").to_pylist()), np.uint64).reshape(-1, width))
        held = come if held is None else [np.concatenate(p) for p in zip(held, come)]
        new = np.ones(len(held[0]), dtype=bool)
        new[1:] = np.any([h[1:] != h[:-1] for h in held[:3]], axis=0)
        held = [h[new] for h in held]
        last = int(np.flatnonzero((held[0] == held[0][-1]) & (held[1] == held[1][-1]))[0])  # the tile that may go on
        if last:
            yield [h[:last] for h in held]
            held = [h[last:] for h in held]
    if held is not None:
        yield held


def tile_bounds(tiles: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and rows of every (tile, part)."""
    starts = np.flatnonzero(np.concatenate([[True], (tiles[1:] != tiles[:-1]) | (parts[1:] != parts[:-1])]))
    return starts, np.diff(np.concatenate([starts, [len(tiles)]]))


def _split_tiles(batches: Iterator[pa.RecordBatch], small: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (tile, part, class): pairs of small tiles, members (b null) of larger or dealt ones."""
    for tiles, parts, classes in whole_tiles(batches):
        starts, sizes = tile_bounds(tiles, parts)
        whole = parts[starts] == 0
        for size in np.unique(sizes[whole & (sizes > 1) & (sizes <= small)]).tolist():
            of = starts[whole & (sizes == size)]
            held = classes[of[:, None] + np.arange(size)]
            x, y = np.triu_indices(size, 1)
            yield tile_rows(np.repeat(tiles[of], len(x)), held[:, x].ravel(), held[:, y].ravel())
        large = np.repeat(~whole | (sizes > small), sizes)
        if large.any():
            yield tile_rows(tiles[large], classes[large])


def _groups(members: DataFrame) -> DataFrame:
    """(group, class) such that classes of one tile are in one group; see the module."""
    sizes = members.groupBy("tile").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    told = materialise(members.join(sizes, "tile"))
    home = told.groupBy("class").agg(F.max(F.struct("size", "tile")).alias("home")).select("class", F.col("home.tile").alias("home"))
    votes = told.join(home, "class").groupBy("tile", "size", "home").agg(F.count(F.lit(1)).alias("votes"))
    target = materialise(votes.groupBy("tile").agg(F.max("size").alias("size"), F.max(F.struct("votes", "home")).alias("most"))
                         .select("tile", "size", F.col("most.home").alias("target")))
    dealt = told.join(target.select("tile", "target"), "tile")
    joint = materialise(dealt.select(F.col("target").alias("group"), "class").distinct())
    apart = (target.groupBy("target").agg(F.sum(F.col("size") * F.col("size")).alias("by_tile"))
             .join(joint.groupBy(F.col("group").alias("target")).agg(F.count(F.lit(1)).alias("n")), "target")
             .where(F.col("n") * F.col("n") > F.greatest("by_tile", F.lit(_BLOCK_ROWS * 64))).select("target"))
    apart = materialise(apart)
    out = materialise(joint.join(apart, F.col("group") == F.col("target"), "left_anti").union(
        dealt.join(apart, "target").select(F.col("tile").alias("group"), "class")).distinct())
    discard(told, target, joint, apart)
    return out


def _blocks(groups: DataFrame, num: int, den: int, rows: int, elements: int) -> DataFrame:
    """(group, class, n, copies, earlier, x, i, y, j, first, second): a class in every pair of blocks it is compared in.

    ``groups`` has group, class, n, copies, earlier. A block is of one band of
    set sizes; a link's sets lie in one band or in neighbouring ones.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / (1.001 * math.log(den / num))).cast("int") + 1
    totals = groups.groupBy("group").agg(F.count(F.lit(1)).alias("all_rows"), F.sum("n").alias("all_elements"))
    single = (F.col("all_rows") <= rows) & (F.col("all_elements") <= elements)
    held = groups.join(totals, "group").withColumn("band", F.when(single, 0).otherwise(band)).drop("all_rows", "all_elements")
    many = materialise(held.groupBy("group", "band").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / rows, F.sum("n") / elements)).cast("int").alias("m")))
    for name, step in (("own_m", 0), ("up_m", 1), ("down_m", -1)):
        of = many.select(F.col("group").alias("g"), (F.col("band") - step).alias("b"), F.col("m").alias(name))
        held = held.join(of, (F.col("group") == F.col("g")) & (F.col("band") == F.col("b")), "left").drop("g", "b")
    own = F.pmod(F.xxhash64("class"), F.col("own_m")).cast("int")
    held = held.withColumn("own", own)

    def pair(x, i, y, j):
        return F.struct(x.cast("int").alias("x"), i.cast("int").alias("i"), y.cast("int").alias("y"), j.cast("int").alias("j"))

    def span(m):
        return F.when(F.col(m) > 0, F.sequence(F.lit(0), F.col(m) - 1)).otherwise(F.array().cast("array<int>"))

    b, o = F.col("band"), F.col("own")
    pairs = F.concat(F.transform(span("own_m"), lambda h: pair(b, F.least(o, h), b, F.greatest(o, h))),
                     F.transform(span("up_m"), lambda h: pair(b, o, b + 1, h)),
                     F.transform(span("down_m"), lambda h: pair(b - 1, h, b, o)))
    at = held.withColumn("pair", F.explode(pairs))
    return at.select("group", "class", "n", "copies", "earlier", "pair.*",
                     ((b == F.col("pair.x")) & (o == F.col("pair.i"))).alias("first"),
                     ((b == F.col("pair.y")) & (o == F.col("pair.j"))).alias("second"))


# --- step 3: checks --------------------------------------------------------

def near_rows(sizes: np.ndarray, maps: list[np.ndarray], first: np.ndarray, second: np.ndarray, earlier: list,
              num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """(r, rows after r that may link with it) for sets in order of size, by bitmaps (see :func:`bitmap`).

    Pairs are of two blocks (or one, if all rows are in both); those that share an earlier group are left to it.
    """
    before = [frozenset(e) if e is not None and len(e) else None for e in earlier]
    shared = np.array([e is not None for e in before], dtype=bool)
    ends = np.searchsorted(sizes, sizes * den // num, side="right")
    widths = np.array([len(m) for m in maps])
    for width in np.unique(widths).tolist():
        # bitmaps grow with sets: partners have this width or the next ones, which are folded to it
        start, stop = np.searchsorted(widths, width), np.searchsorted(widths, width, side="right")
        last = int(ends[start:stop].max())
        rows = np.vstack([np.bitwise_xor.reduce(m.reshape(-1, width)) if len(m) > width else m for m in maps[start:last]])
        rows = rows.view(np.uint64)
        for r in range(start, stop):
            y = np.arange(r + 1, ends[r])
            y = y[(first[r] & second[y]) | (second[r] & first[y])]
            both = sizes[r] + sizes[y]
            differ = np.bitwise_count(rows[r - start] ^ rows[y - start]).sum(axis=1, dtype=np.int64)
            y = y[(both - differ) * (den + num) >= 2 * num * both]
            if shared[r] and len(y):
                y = y[[not (shared[k] and before[r] & before[k]) for k in y.tolist()]]
            if len(y):
                yield r, y


def compare_block(classes: np.ndarray, copies: np.ndarray, first: np.ndarray, second: np.ndarray,
                  earlier: list, elements: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """For classes of two blocks (or one), by size: the class each is joined to, and the documents it links with."""
    sizes = np.array([len(e) for e in elements])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    vocabulary, ids = np.unique(np.concatenate(elements), return_inverse=True)
    mark = np.zeros(len(vocabulary), dtype=np.uint8)
    label, links = np.arange(len(sizes)), np.zeros(len(sizes), dtype=np.int64)
    for r, y in near_rows(sizes, [bitmap(e) for e in elements], first, second, earlier, num, den):
        mark[ids[starts[r]:starts[r + 1]]] = 1
        if len(y) * 4 > y[-1] - y[0]:  # marks of all arrays from the first to the last
            span = mark[ids[starts[y[0]]:starts[y[-1] + 1]]]
            common = np.add.reduceat(span, starts[y[0]:y[-1] + 1] - starts[y[0]], dtype=np.int64)[y - y[0]]
        else:
            common = np.array([int(mark[ids[starts[k]:starts[k + 1]]].sum()) for k in y.tolist()])
        mark[ids[starts[r]:starts[r + 1]]] = 0
        y = y[common * (den + num) >= num * (sizes[r] + sizes[y])]
        if len(y):
            links[r] += copies[y].sum()
            links[y] += copies[r]
            old = np.unique(label[np.append(y, r)])
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
    return classes[label], links


def _by_size(held: pa.Table) -> pa.Table:
    """A row of each class, in order of set size."""
    _, at = np.unique(held.column("class").to_numpy(), return_index=True)
    return held.take(pa.array(at[np.argsort(held.column("n").to_numpy()[at], kind="stable")]))


def _bound(num: int, den: int):
    """Of the classes in a pair of blocks those that may link with another one there."""
    def bound(held: pa.Table) -> pa.Table:
        held = _by_size(held)
        maps = [np.frombuffer(m, np.uint8) for m in held.column("bits").to_pylist()]
        near = np.zeros(held.num_rows, dtype=bool)
        for r, y in near_rows(held.column("n").to_numpy(), maps, held.column("first").to_numpy(),
                              held.column("second").to_numpy(), held.column("earlier").to_pylist(), num, den):
            near[r] = True
            near[y] = True
        held = held.drop_columns(["bits"]).filter(pa.array(near))
        lists = held.column("earlier").cast(pa.list_(pa.field("element", pa.int64())))
        return held.set_column(held.column_names.index("earlier"), "earlier", lists)

    return bound


def _compare(num: int, den: int):
    def compare(held: pa.Table) -> pa.Table:
        held = _by_size(held)
        elements = [np.frombuffer(e, np.uint64) for e in held.column("elements").to_pylist()]
        joined, links = compare_block(*(held.column(c).to_numpy() for c in ("class", "copies", "first", "second")),
                                      held.column("earlier").to_pylist(), elements, num, den)
        return pa.table({"class": held.column("class"), "joined": pa.array(joined), "links": pa.array(links)})

    return compare


def _may_link(num: int, den: int):
    """Pairs (a, b, ac, bc, an, bn, x, y: bitmaps) whose bound reaches the threshold."""
    def bound(batches):
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("an", "bn", "x", "y"))
            ok = [(an + bn - differing_bits(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))) * (den + num)
                  >= 2 * num * (an + bn) for an, bn, x, y in zip(*cols)]
            yield batch.select(["a", "b", "ac", "bc"]).filter(pa.array(ok, pa.bool_()))

    return bound


def _check(num: int, den: int):
    """Pairs (a, b, ac, bc, x, y: elements) that reach the threshold."""
    def check(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(len(np.intersect1d(x, y, assume_unique=True)) * (den + num) >= num * (len(x) + len(y)))
            yield batch.select(["a", "b", "ac", "bc"]).filter(pa.array(ok, pa.bool_()))

    return check


def link(found: Profile, named: DataFrame, num: int, den: int, small_tile: int = 6,
         block_rows: int = _BLOCK_ROWS, block_elements: int = _BLOCK_ELEMENTS, split_tiles=_split_tiles) -> DataFrame:
    """(class, component, links) of every class: a class of its component, and documents of other sets that link.

    ``named`` has (tile, part, class) and what ``split_tiles`` needs beside, see :class:`Profile`.
    """
    dealt = named.repartition("tile", "part").sortWithinPartitions("tile", "part", "class")
    split = materialise(dealt.mapInArrow(lambda b: split_tiles(b, small_tile), "tile long, a long, b long"))
    groups = _groups(split.where("b is null").select("tile", F.col("a").alias("class")))
    held = groups.groupBy("class").agg(F.collect_set("group").alias("groups"))
    classes = found.classes.select("class", "n", "copies", "bits").join(held, "class", "left")

    # pairs of small tiles that no group compares
    x, y = (classes.select(F.col("class").alias(c), F.col("n").alias(f"{c}n"), F.col("copies").alias(f"{c}c"),
                           F.col("bits").alias(m), F.col("groups").alias(f"{c}g")) for c, m in (("a", "x"), ("b", "y")))
    alike = F.least("an", "bn") * den >= F.greatest("an", "bn") * num
    apart = ~F.coalesce(F.arrays_overlap("ag", "bg"), F.lit(False))
    pairs = split.where("b is not null").select("a", "b").distinct().join(x, "a").join(y, "b").where(alike & apart)
    pairs = materialise(pairs.select("a", "b", "ac", "bc", "an", "bn", "x", "y")
                        .mapInArrow(_may_link(num, den), "a long, b long, ac long, bc long"))

    # groups: bitmaps of two blocks first, arrays only of classes that may link there
    held = groups.join(classes.select("class", "n", "copies", "groups"), "class").select(
        "group", "class", "n", "copies", F.filter("groups", lambda g: g < F.col("group")).alias("earlier"))
    blocks = _blocks(held, num, den, block_rows, block_elements)
    shape = ", ".join(f"`{c}` {t}" for c, t in blocks.dtypes)
    blocks = materialise(blocks.join(classes.select("class", "bits"), "class").select(*blocks.columns, "bits")
                         .groupBy("group", "x", "i", "y", "j").applyInArrow(_bound(num, den), shape))

    wanted = materialise(pairs.select(F.col("a").alias("class")).union(pairs.select("b"))
                         .union(blocks.select("class")).distinct())
    arrays = found.arrays(wanted)
    x, y = (arrays.select(F.col("class").alias(c), F.col("elements").alias(e)) for c, e in (("a", "x"), ("b", "y")))
    links = materialise(pairs.join(x, "a").join(y, "b").mapInArrow(_check(num, den), "a long, b long, ac long, bc long"))
    met = materialise(blocks.join(arrays, "class").groupBy("group", "x", "i", "y", "j").applyInArrow(
        _compare(num, den), "class long, joined long, links long"))

    counts = (links.select(F.col("a").alias("class"), F.col("bc").alias("links"))
              .union(links.select("b", "ac")).union(met.where("links > 0").select("class", "links"))
              .groupBy("class").agg(F.sum("links").alias("links")))
    edges = links.select("a", "b").union(met.where("class != joined").select("class", "joined"))
    joined = components(edges)
    out = materialise(found.classes.select("class", "least").join(joined, F.col("class") == F.col("node"), "left")
                      .join(counts, "class", "left")
                      .select("class", "least", F.coalesce("component", "class").alias("component"),
                              F.coalesce("links", F.lit(0)).alias("links")))
    discard(split, groups, pairs, blocks, wanted, arrays, links, met)
    return out


def document_links(found: Profile, linked: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, class, component, component_id, n_links of every row.

    ``component_id`` is the least document id of the component (null ids
    count for nothing; a component of null ids alone has none), ``n_links`` the number
    of other rows the row links with, copies of its own set included. Rows without words
    have no class, no links and are their own component.
    """
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    copies = found.classes.select("class", "copies")
    per_class = linked.join(named, "component").join(copies, "class").select(
        F.col("class").alias("of"), "component", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return found.rows.join(per_class, F.col("class") == F.col("of"), "left").select(
        "doc_id", "key", "n_shingles", "class", "component",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one_of_each(docs: DataFrame, told: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (nulls last), then the least key; one of repeated rows.

    Rows without words all stay. Rows that surely stay are told by a bit set of the
    others' keys, so only texts of components of two rows and more are shuffled.
    """
    worded = told.where("class is not null")
    chosen = materialise(worded.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("k"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1").select("component", F.col("k.doc_id").alias("doc_id"), F.col("k.key").alias("key")))
    crowd = materialise(worded.join(chosen.select(F.col("component").alias("c")), F.col("component") == F.col("c"), "left_semi")
                        .select(F.col("key").alias("of")).distinct())
    keys = KeySet(crowd)
    columns = docs.columns
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"),
                        F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).alias("row_key"))
    whole = whole.withColumn("crowded", keys.may_hold(F.col("row_key")))
    stay = whole.where(~F.col("crowded")).select("row")
    near = whole.where("crowded")
    alone = near.join(crowd, F.col("row_key") == F.col("of"), "left_anti").select("row")
    kept = (near.join(chosen, (F.col("row_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("doc_id")))
            .groupBy("component").agg(F.first("row").alias("row")).select("row"))
    return stay.union(alone).union(kept).select("row.*")

"""Groups of documents whose sets of word shingles are similar, found exactly.

Candidates. Sets of sizes a <= b with a Jaccard similarity of p % or more differ in at most
k = a (100 - p) / p shingles. Hash values are cut into k + 1 + e ranges, so such sets agree wholly in
e + 1 ranges at least, and in one of the k + 1 fullest of either. A set emits the hash of its content in each of those.
Only sets with more than e empty ranges could agree in those alone: they emit each choice of e + 1 of them, or where there
are many ranges, and e is such that it hardly occurs, one key for all. Sets with no key in common are not similar. Bands
of sizes fix k: a similar set is in the same or the next band, so each set emits keys for its own
band and for the one below. Common passages make few common keys, as a key needs all of a text's
shingles in its range, and ranges that hold a single one are seldom among the fullest.

Tiles. Sets that share keys are tied to coarse groups, which are cut by band, and further by hash
until the shingles of a cell fit a task; a tile is a pair of cells whose bands touch. Every set has a hashed bitmap of one
or two bits a shingle; bits set in one and clear in another bound the overlap from above. Groups that are too large for one
tile are first dealt out as bitmaps alone: sets that the bounds do not tie, directly or through others, fall apart. Then whole
sets are dealt, in a tile the bounds hold once more, and only pairs that pass, and that links found so far do not
connect, are intersected as sorted arrays.

Equal sets take part once. Links then tie sets, and documents, to their smallest doc_id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import join_by_size
from stratamart.llm.components import connected_components
from stratamart.llm.textblocks import mix, text_blocks, windows, words
from stratamart.workspace import materialize

SHINGLE = 3
PERCENT = 90
CELL_SHINGLES = 2 << 20
CELL_SETS = 4096
BITMAP_BITS = 4096
# Cells of bitmaps, which take a fortieth of the bytes of sets.
BITMAP_CELL_SHINGLES = 32 << 20
BITMAP_CELL_SETS = 8192
BROADCAST_BYTES = 24 << 20
COMBINE_KEYS = 1 << 18
FEW_PARTS = 128

_A, _B, _C = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F))


def bands(n: np.ndarray | int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Band of each size, and the largest size of each band up to the largest size given."""
    tops = []
    low, most = 1, int(np.max(n, initial=1))
    while low <= most:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    tops = np.asarray(tops or [1])
    return np.searchsorted(tops, n), tops


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; of all its words where it has fewer."""
    w = words(data, offsets)
    at, hashes = windows(w, n)
    counts = np.diff(w.first)
    cuts = np.searchsorted(at, w.first)
    out = []
    for k, count in enumerate(counts):
        if count >= n:
            out.append(np.unique(hashes[cuts[k] : cuts[k + 1]]))
        else:
            h = np.full(min(count, 1), count, np.uint64)
            for x in w.hashes[w.first[k] : w.first[k + 1]]:
                h = mix(h * _A + x)
            out.append(h)
    return out


def _fingerprint(s: np.ndarray) -> np.uint64:
    one, two = mix(s * _A).sum(dtype=np.uint64), mix(s ^ _B).sum(dtype=np.uint64)
    return mix(np.array([one ^ mix(np.array([two + np.uint64(len(s))]))[0]]))[0]


def _keys(s: np.ndarray, percent: int, band: int, tops: np.ndarray) -> np.ndarray:
    """Keys of a sorted set for its band and the one below."""
    # Ranges hold fewer shingles where fewer are shared, so that more of them are empty by chance.
    least_spare = max(1, (100 - percent) // 5 - 1)
    sums = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s + _C), out=sums[1:])
    high = s >> np.uint64(32)
    out = []
    for b in (band, band - 1):
        if b < 0:
            continue
        differ = int(tops[b]) * (100 - percent) // percent
        spare = least_spare + differ * 35 // 100
        parts = differ + 1 + spare
        ranks = (high * np.uint64(parts)) >> np.uint64(32)
        edges = np.searchsorted(ranks, np.arange(parts + 1, dtype=np.uint64))
        tag = np.uint64(b) << np.uint64(40)
        held = np.diff(edges)
        # One of the differ + 1 fullest ranges is among those that agree: the others need no key. A range
        # that agrees is as full in the other set, so whichever of the two keeps to fuller ranges decides.
        least = max(1, int(np.partition(held, parts - differ - 1)[parts - differ - 1]))
        full = np.flatnonzero(held >= least)
        content = sums[edges[full + 1]] - sums[edges[full]]
        out.append(mix(content * _A + mix(tag + full.astype(np.uint64))))
        empty = np.flatnonzero(edges[1:] == edges[:-1]).astype(np.uint64)
        if len(empty) > spare:
            h = np.full(1, tag, np.uint64)
            if parts <= FEW_PARTS:
                for column in np.array(list(itertools.combinations(empty, spare + 1)), np.uint64).T:
                    h = mix(h * _B + column)
            out.append(mix(h))
    return np.concatenate(out)


def bitmap(s: np.ndarray) -> bytes:
    """A bit for the hash of each shingle, in the power of two that is not below the size, 128 at least."""
    bits = np.zeros(max(128, 1 << max(len(s) - 1, 0).bit_length()), bool)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def likely_links(sizes: np.ndarray, bitmaps: list[bytes], cells: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of indexes that tie all sets whose bitmaps do not rule similarity out; of two cells, pairs across them only.

    Sets in the order of their sizes; similar ones have bitmaps of the same length or one of twice the other's, whose
    halves are then laid over each other.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, cells = sizes[order], cells[order]
    lengths = np.array([len(bitmaps[k]) for k in order])
    across = cells.min(initial=0) != cells.max(initial=0)
    group = np.arange(len(order))
    links = []
    for length in np.unique(lengths):
        own, twice = np.flatnonzero(lengths == length), np.flatnonzero(lengths == 2 * length)
        rows = [np.frombuffer(bitmaps[order[k]], np.uint64) for k in own]
        for k in twice:
            wide = np.frombuffer(bitmaps[order[k]], np.uint64)
            rows.append(wide[: len(wide) // 2] | wide[len(wide) // 2 :])
        bits, first = np.array(rows).reshape(len(rows), length // 8), int(own[0])
        for i in own:
            last = min(int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right")), first + len(bits))
            j = np.arange(i + 1, last)
            j = j[group[j] != group[i]]
            if across:
                j = j[cells[j] != cells[i]]
            for start in range(0, len(j), 4096):
                some = j[start : start + 4096]
                mine = np.bitwise_count(bits[i - first] & ~bits[some - first]).sum(axis=1, dtype=np.int64)
                theirs = np.bitwise_count(bits[some - first] & ~bits[i - first]).sum(axis=1, dtype=np.int64)
                most = np.minimum(sizes[i] - mine, sizes[some] - theirs)
                for k in some[100 * most >= percent * (sizes[i] + sizes[some] - most)]:
                    if group[k] != group[i]:
                        links.append((int(order[i]), int(order[k])))
                        group[group == group[k]] = group[i]
    return links


def _prints(n: int):
    """Hash of the text, size, fingerprint and bitmap of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches):
            found = shingle_sets(data, offsets, n)
            sizes = pa.array([len(s) for s in found], pa.int64())
            prints = pa.array([int(_fingerprint(s).view(np.int64)) for s in found], pa.int64())
            bits = pa.array([bitmap(s) for s in found], pa.binary())
            yield pa.record_batch(
                [rows.column("doc_id"), rows.column("text_hash"), sizes, prints, bits],
                ["doc_id", "text_hash", "n_shingles", "fp", "bits"],
            )

    return run


def _keyed(n: int, percent: int):
    """(key, fp) of every set's keys; a task emits a set, and a key that several sets share, once.

    A set whose key was emitted for another is tied to that one by a key that only the two have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: set[int] = set()
        holders: dict[int, int] = {}
        for _, data, offsets in text_blocks(batches):
            found = shingle_sets(data, offsets, n)
            band, tops = bands(np.array([len(s) for s in found]), percent)
            keys, prints = [], []
            for s, b in zip(found, band, strict=True):
                fp = int(_fingerprint(s).view(np.int64))
                if not len(s) or fp in sets:
                    continue
                sets.add(fp)
                tied = set()
                for key in _keys(s, percent, int(b), tops).view(np.int64).tolist():
                    holder = holders.setdefault(key, fp)
                    if holder == fp:
                        keys.append(key)
                        prints.append(fp)
                    else:
                        tied.add(holder)
                for holder in tied:
                    pair = mix(np.array([holder, fp], np.int64).view(np.uint64))
                    key = int(mix(pair[:1] * _A + pair[1:]).view(np.int64)[0])
                    keys += [key, key]
                    prints += [holder, fp]
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(prints, pa.int64())], ["key", "fp"])
            if len(holders) > COMBINE_KEYS:
                sets, holders = set(), {}

    return run


def _chosen(n: int):
    """The sets of the candidates, from their texts; a text whose set is not the one meant is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches):
            found = shingle_sets(data, offsets, n)
            meant = rows.column("fp").to_pylist()
            keep = [k for k, s in enumerate(found) if int(_fingerprint(s).view(np.int64)) == meant[k]]
            part = rows.take(pa.array(keep, pa.int64()))
            shingles = pa.array([found[k].tobytes() for k in keep], pa.binary())
            yield pa.record_batch([part.column("fp"), part.column("places"), shingles], ["fp", "places", "shingles"])

    return run


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def tile_links(sets: list[np.ndarray], cells: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of indexes of similar sets, enough to connect all that are; of two cells, pairs across them only."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sets, cells = [sets[k] for k in order], cells[order]
    sizes = np.array([len(s) for s in sets])
    bits = np.zeros((len(sets), BITMAP_BITS // 8), np.uint8)
    for k, s in enumerate(sets):
        place = (s & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
        np.bitwise_or.at(bits[k], place >> 3, np.left_shift(np.uint8(1), (place & 7).astype(np.uint8)))
    bits = bits.view(np.uint64)
    across = cells.min(initial=0) != cells.max(initial=0)
    group = np.arange(len(sets))
    links = []
    for i in range(len(sets)):
        last = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        j = np.arange(i + 1, last)
        j = j[group[j] != group[i]]
        if across:
            j = j[cells[j] != cells[i]]
        for first in range(0, len(j), 4096):
            some = j[first : first + 4096]
            mine = np.bitwise_count(bits[i] & ~bits[some]).sum(axis=1, dtype=np.int64)
            theirs = np.bitwise_count(bits[some] & ~bits[i]).sum(axis=1, dtype=np.int64)
            most = np.minimum(sizes[i] - mine, sizes[some] - theirs)
            for k in some[100 * most >= percent * (sizes[i] + sizes[some] - most)]:
                if group[k] == group[i]:
                    continue
                common = _overlap(sets[i], sets[k])
                if 100 * common >= percent * (sizes[i] + sizes[k] - common):
                    links.append((order[i], order[k]))
                    group[group == group[k]] = group[i]
    return links


def similar_documents(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) per row of docs.

    Two documents link when 100 x common shingles >= ``percent`` x shingles of either. Texts of fewer
    than ``n`` words have one shingle, the words they have; texts without words, and null texts, have
    none and link with nothing: their component is their own doc_id. Repeated rows are equal texts and
    link. Rows that share a doc_id count each by its own text. A null doc_id is never the smallest:
    such a row has the smallest doc_id that its text reaches, or null; it links as others do only
    through a text that some row with an id has too. Whole texts are read. Other columns are ignored.
    """
    scanned, merged = _sets_and_components(docs, n, percent)
    smallest = merged.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # Only sets in a component of several need another document's id.
    named = merged.join(smallest, "component").select("fp", "component_id")
    full = scanned.where("n_shingles > 0").select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
    empty = scanned.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").union(empty)


def _sets_and_components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row its text's hash and set; per set that some row with an id has, its smallest doc_id and its component."""
    texts = docs.select("doc_id", "text")
    # Texts are read again for the keys, of which there are many times more, rather than store them.
    hashed = texts.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    scanned = materialize(
        hashed.mapInArrow(_prints(n), "doc_id long, text_hash long, n_shingles long, fp long, bits binary"), "shingles"
    )
    keyed = texts.select("text").mapInArrow(_keyed(n, percent), "key long, fp long")
    # Within a key each set is tied to the one before it: rows stream by, a key's sets are never held.
    chain = keyed.selectExpr("fp AS a", "lag(fp) OVER (PARTITION BY key ORDER BY fp) AS b")
    coarse = connected_components(chain.where("a != b"))

    sets = scanned.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles")
    )
    candidates = materialize(
        sets.join(coarse, sets.fp == coarse.vertex).select("doc_id", "fp", "n_shingles", F.col("component").alias("tile_group")),
        "candidates",
    )
    candidates = _finer_groups(candidates, scanned, percent)
    # Which tiles a set goes to is settled without the sets, which then cross the network once for each.
    placed = materialize(_placed(candidates, percent, CELL_SHINGLES, CELL_SETS), "tiles")
    fetched = (
        join_by_size(texts, placed, "doc_id", "inner", 64 * F.size("places"), BROADCAST_BYTES)
        .select("text", "fp", "places")
        .mapInArrow(_chosen(n), "fp long, places array<struct<tile:string,cell:int>>, shingles binary")
        .select("fp", F.explode("places").alias("place"), "shingles")
    )
    links = materialize(_links(fetched.select("place.tile", "place.cell", "fp", "shingles"), percent), "links")

    fine = connected_components(links)
    merged = sets.join(fine, sets.fp == fine.vertex, "left").select(
        "fp", "doc_id", F.coalesce("component", "fp").alias("component")
    )
    return scanned, merged


def _finer_groups(candidates: DataFrame, scanned: DataFrame, percent: int) -> DataFrame:
    """Candidates again, groups that do not fit a tile cut to what bitmaps tie; sets that they tie to none go."""
    sized = materialize(_sized(candidates, CELL_SHINGLES, CELL_SETS), "sized")
    large = sized.where("NOT whole").select(*candidates.columns)
    if large.isEmpty():
        return candidates
    bits = scanned.where("n_shingles > 0").join(large.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.first("bits").alias("bits"))
    placed = _placed(large, percent, BITMAP_CELL_SHINGLES, BITMAP_CELL_SETS)
    dealt = placed.select("fp", "n_shingles", F.explode("places").alias("place")).join(bits, "fp")

    def run(group: pa.Table) -> pa.Table:
        prints = group.column("fp").to_pylist()
        sizes, cells = group.column("n_shingles").to_numpy(), group.column("cell").to_numpy()
        links = likely_links(sizes, group.column("bits").to_pylist(), cells, percent)
        ends = [pa.array([prints[pair[k]] for pair in links], pa.int64()) for k in (0, 1)]
        return pa.table(dict(zip("ab", ends, strict=True)))

    tied = dealt.select("place.tile", "place.cell", "fp", "n_shingles", "bits").groupBy("tile").applyInArrow(run, "a long, b long")
    finer = connected_components(tied)
    cut = large.drop("tile_group").join(finer, large.fp == finer.vertex).select("doc_id", "fp", "n_shingles", F.col("component").alias("tile_group"))
    return materialize(sized.where("whole").select(*candidates.columns).unionByName(cut), "finer")


def _sized(candidates: DataFrame, shingles: int, sets: int) -> DataFrame:
    """Candidates and whether their group fits one tile."""
    total = candidates.groupBy("tile_group").agg(F.sum("n_shingles").alias("in_group"), F.count("*").alias("group_sets"))
    return candidates.join(total, "tile_group").withColumn("whole", (F.col("in_group") <= shingles) & (F.col("group_sets") <= sets))


def _placed(candidates: DataFrame, percent: int, most_shingles: int, most_sets: int) -> DataFrame:
    """For each candidate the tiles that it goes to, and its cell there: doc_id, fp, n_shingles, places."""
    _, tops = bands(1 << 40, percent)
    # A logarithm would round: count the bands whose largest size is less.
    band = F.size(F.filter(F.array(*[F.lit(int(t)) for t in tops]), lambda t: t < F.col("n_shingles")))
    sized = _sized(candidates, most_shingles, most_sets).withColumn("band", band)

    def place(tile, cell):
        return F.struct(tile.alias("tile"), cell.cast("int").alias("cell"))

    alone = sized.where("whole").select(
        "doc_id", "fp", "n_shingles", F.array(place(F.col("tile_group").cast("string"), F.lit(0))).alias("places")
    )
    large = sized.where("NOT whole")
    cells = large.groupBy("tile_group", "band").agg(
        F.ceil(F.greatest(F.sum("n_shingles") / most_shingles, F.count("*") / most_sets)).cast("int").alias("cells")
    )
    after = cells.select("tile_group", (F.col("band") - 1).alias("band"), F.col("cells").alias("cells_after"))
    before = cells.select("tile_group", (F.col("band") + 1).alias("band"), F.col("cells").alias("cells_before"))
    ways = cells.join(after, ["tile_group", "band"], "left").join(before, ["tile_group", "band"], "left")
    own = large.join(ways, ["tile_group", "band"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int"))

    def name(band_low, low, band_high, high):
        return F.concat_ws("/", F.col("tile_group"), band_low, low, band_high, high)

    here = F.transform(
        F.sequence(F.lit(0), F.col("cells") - 1),
        lambda k: name(F.col("band"), F.least(k, F.col("own")), F.col("band"), F.greatest(k, F.col("own"))),
    )
    up = F.when(
        F.col("cells_after").isNotNull(),
        F.transform(F.sequence(F.lit(0), F.col("cells_after") - 1), lambda k: name(F.col("band"), F.col("own"), F.col("band") + 1, k)),
    )
    down = F.when(
        F.col("cells_before").isNotNull(),
        F.transform(F.sequence(F.lit(0), F.col("cells_before") - 1), lambda k: name(F.col("band") - 1, k, F.col("band"), F.col("own"))),
    )
    none = F.array().cast("array<string>")
    every = F.concat(here, F.coalesce(up, none), F.coalesce(down, none))
    cell = F.col("band") * 100000 + F.col("own")
    spread = own.select("doc_id", "fp", "n_shingles", F.transform(every, lambda tile: place(tile, cell)).alias("places"))
    return alone.union(spread)


def _links(fetched: DataFrame, percent: int) -> DataFrame:
    """Links between sets of the same tile."""

    def run(group: pa.Table) -> pa.Table:
        prints = group.column("fp").to_pylist()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
        links = tile_links(sets, group.column("cell").to_numpy(), percent)
        return pa.table(
            {
                "a": pa.array([prints[i] for i, _ in links], pa.int64()),
                "b": pa.array([prints[j] for _, j in links], pa.int64()),
            }
        )

    return fetched.groupBy("tile").applyInArrow(run, "a long, b long")


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of similar documents: that with the smallest doc_id, and of several such one text of them.

    Rows count, not ids: of equal rows one stays, and a row goes whose text is like that of a row kept under another or
    under the same id. Rows without an id come after those with one; they go with the rows whose set of shingles they
    have, and one of those stays that have a set no row with an id has. Texts without words are like nothing and stay.
    """
    scanned, merged = _sets_and_components(docs, n, percent)
    rows = scanned.groupBy("fp", "doc_id", "text_hash", (F.col("n_shingles") > 0).alias("held")).agg(F.count("*").alias("n"))
    placed = rows.where("held").join(merged.select("fp", "component"), "fp", "left")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n")).alias("first")
    chosen = placed.groupBy(F.coalesce("component", "fp").alias("component")).agg(first).select("first.*")
    chosen = materialize(
        chosen.select("doc_id", "text_hash", (F.col("n") > 1).alias("repeated")).unionByName(
            rows.where("NOT held").select("doc_id", "text_hash", F.lit(False).alias("repeated"))
        ),
        "chosen",
    )
    columns = [F.col(f"_row.{c}").alias(c) for c in docs.columns]
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")
    )
    same = F.col("_id").eqNullSafe(F.col("_kept.doc_id")) & (F.col("_hash") == F.col("_kept.text_hash"))
    met = keyed.join(chosen.where("NOT repeated").alias("_kept"), same, "left_semi").select(*columns)
    # Equal rows are few texts, whatever the number of their rows.
    several = keyed.join(chosen.where("repeated").alias("_kept"), same, "left_semi")
    return met.union(several.groupBy("_id", "_hash").agg(F.any_value("_row").alias("_row")).select(*columns))

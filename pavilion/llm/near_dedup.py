"""Near-duplicate groups by one-permutation MinHash.

Every document is a set of word shingles. One hash function orders them; its
range is cut into bins and the smallest value in each bin is the signature.
Empty bins borrow from a bin chosen by hashing the empty bin's own number and
an attempt count (optimal densification). Bands of signature values are the
buckets. Within a bucket, pairs form stars around hubs, never all pairs, and
every candidate pair is confirmed on the full shingle sets.

A star alone would lose the link between two members that are unlike the hub.
So buckets stay open while their members belong to several components. The hubs
leave, as they have met everybody, and so does each member of which the triangle
inequality of the Jaccard distance says that nobody left can be like it and
unlike its hub. The rest meets new hubs, those nearest to the last hub first,
since a common original is near to all its copies. What is still undecided, as
where many texts share a template and so every key, is settled exactly by rare
shingles: of two texts that are alike, the rarest shingles of the smaller one
have one in common with the rarest of the larger one (a prefix filter). Under
these keys hubs are met until no key has members of different components left.
So a link is lost only if its two texts share no band.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavilion.llm import arrays, workers
from pavilion.llm.arrays import U
from pavilion.llm.components import components
from pavilion.llm.storage import stored
from pavilion.llm.workers import mapped

SHINGLE_WORDS = 5
# 28 bands of 6 bins: a pair at a similarity of 0.85 shares no band with a
# probability of (1 - 0.85**6)**28 = 2e-6, one at 0.3 is a candidate with 2 %.
BANDS, ROWS = 28, 6
BINS = BANDS * ROWS
MISS, MOST_BANDS = 2e-6, 64
# Hubs under each rare key at first; every further round has twice as many.
RARE_HUBS = 4


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows at which a pair at ``percent`` hundredths shares no band with ``MISS`` at most.

    As many rows as ``MOST_BANDS`` allow, up to ``ROWS``, or else one.
    """
    if percent >= 100:
        return 1, ROWS
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))
        if bands <= MOST_BANDS:
            break
    return bands, rows


def shingle_hashes(texts: list[bytes], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buffer, begins = arrays.joined(texts)
    buffer = arrays.LOWER[buffer]
    starts, ends = arrays.word_bounds(buffer, arrays.SPACES)
    hashes = arrays.range_hashes(buffer, starts, ends)
    first = np.searchsorted(starts, begins)
    factors = arrays.multipliers(words, 1)
    n = len(hashes)
    whole = np.zeros(n, dtype=U)
    for j in range(words):
        whole[: max(0, n - j)] += hashes[j:] * factors[j]
    whole = arrays.mix(whole)
    sets = []
    for begin, end in zip(first[:-1], first[1:], strict=True):
        if end - begin >= words:
            sets.append(np.unique(whole[begin : end - words + 1]))
        elif end > begin:
            short = (hashes[begin:end] * factors[: end - begin]).sum(dtype=U)
            sets.append(arrays.mix(np.array([short], dtype=U) + U(end - begin)))
        else:
            sets.append(np.zeros(0, dtype=U))
    return sets


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One-permutation signatures, densified; rows of empty sets stay zero."""
    signature = np.zeros((len(sets), bins), dtype=U)
    filled = np.zeros((len(sets), bins), dtype=bool)
    width = U((1 << 64) // bins + 1)
    for i, values in enumerate(sets):
        # Sorted values fall into bins in order, so each bin's first is its smallest.
        place, where = np.unique(values // width, return_index=True)
        signature[i, place.astype(np.int64)] = values[where]
        filled[i, place.astype(np.int64)] = True
    rows, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        source = arrays.mix(empty.astype(U) * U(1 << 32) + U(attempt)) % U(bins)
        source = source.astype(np.int64)
        hit = filled[rows, source]
        signature[rows[hit], empty[hit]] = signature[rows[hit], source[hit]]
        rows, empty = rows[~hit], empty[~hit]
    return signature


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ too."""
    cut = signature.reshape(len(signature), bands, -1)
    keys = (cut * arrays.multipliers(cut.shape[2], 2)).sum(axis=2, dtype=U)
    return arrays.mix(keys + arrays.multipliers(bands, 3))


def _set_sum(values: np.ndarray, salt: int) -> np.int64:
    """A 64-bit digest of a set; two salts make 128 bits."""
    return arrays.mix(values + U(salt)).sum(dtype=U).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in arrays.parts(batch, "text"):
            sets = shingle_hashes(texts)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            keys = band_keys(signatures(sets, bands * rows), bands).view(np.int64)
            sums = [
                np.array([_set_sum(s, salt) for s in sets], dtype=np.int64) for salt in (11, 12)
            ]
            buckets = workers.lists(pa.array(keys.ravel()), [bands] * len(sets))
            yield workers.batch(id=part["id"], n=sizes, d1=sums[0], d2=sums[1], bands=buckets)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in arrays.parts(batch, "text"):
            wanted = part["d1"].to_numpy()
            sets = shingle_hashes(texts)
            own = [i for i, s in enumerate(sets) if _set_sum(s, 11) == wanted[i]]
            sets = [sets[i] for i in own]
            values = pa.array(np.concatenate([*sets, np.zeros(0, dtype=U)]).view(np.int64))
            shingles = workers.lists(values, map(len, sets))
            ids = part["id"].take(pa.array(own, pa.int64()))
            yield workers.batch(id=ids, shingles=shingles)


def _tested(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, an, bn) with the size of the intersection of their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("as"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("bs"))
    both = F.size(F.array_intersect("as", "bs")).cast("long")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "an", "bn", both.alias("both"))


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, an, bn) of ``met``, each once, whose sizes allow a link."""
    swap = F.col("id") < F.col("hub")
    return (
        met.where(F.least("n", "hn") * 100 >= F.greatest("n", "hn") * percent)
        .select(
            F.least("id", "hub").alias("a"),
            F.greatest("id", "hub").alias("b"),
            F.when(swap, F.col("n")).otherwise(F.col("hn")).alias("an"),
            F.when(swap, F.col("hn")).otherwise(F.col("n")).alias("bn"),
        )
        .distinct()
    )


def _measured(met: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """``bucket``, ``id``, ``hub`` of ``met`` with ``like`` and the distance ``d``.

    Where the sizes alone rule out a link, ``d`` is a lower bound.
    """
    union = F.col("an") + F.col("bn") - F.col("both")
    facts = tested.select(
        "a", "b", (F.col("both") * 100 >= union * percent).alias("like"), (1 - F.col("both") / union).alias("d")
    )
    bound = 1 - F.least("n", "hn") / F.greatest("n", "hn")
    rows = met.select(
        "bucket", "id", "hub", bound.alias("bound"), F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    ).join(facts, ["a", "b"], "left")
    return rows.select(
        "bucket", "id", "hub", F.coalesce("like", F.lit(False)).alias("like"), F.coalesce("d", "bound").alias("d")
    )


def _undecided(open_: DataFrame, hubs: DataFrame, seen: DataFrame, margin: float) -> DataFrame:
    """Members of ``open_`` that may still have an untested link, and how near they are to a hub.

    Hubs have met everybody. A member that is like its hub is settled if all who
    are unlike that hub are so much farther from it that none can be like the member.
    """
    strangers = stored(
        seen.where("NOT like").groupBy("bucket", "hub").agg(F.min("d").alias("stranger")), "strangers"
    )
    apart = F.coalesce(F.col("stranger") - F.col("d") > margin + 1e-9, F.lit(True))
    about = seen.join(strangers, ["bucket", "hub"], "left").groupBy("bucket", "id").agg(
        F.min("d").alias("near"), F.bool_or(F.col("like") & apart).alias("settled")
    )
    gone = hubs.select("bucket", F.col("hub").alias("id"))
    rest = open_.select("bucket", "id", "n").join(gone, ["bucket", "id"], "left_anti")
    rest = rest.join(stored(about, "about"), ["bucket", "id"], "left")
    return rest.where("NOT coalesce(settled, false)").select(
        "bucket", "id", "n", F.coalesce("near", F.lit(1.0)).alias("near")
    )


def _mixed(open_: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with their component so far, in buckets that hold several components."""
    named = open_.join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "id")), "open")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return named.join(stored(mixed.where("low < high").select("bucket"), "mixed"), "bucket", "left_semi")


def _met(open_: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Members of other components with each of the ``count`` first members of their bucket; these hubs."""
    open_ = stored(open_, "open")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("near", "id"))
    hubs = open_.withColumn("place", place).where(F.col("place") <= count)
    hubs = stored(
        hubs.select("bucket", F.col("id").alias("hub"), F.col("n").alias("hn"), F.col("component").alias("with")), "hubs"
    )
    met = open_.join(hubs, "bucket").where("id != hub AND component != with")
    return met.select("bucket", "id", "n", "hub", "hn"), hubs


def _rare_keys(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members`` (id, n) under their rarest shingles: ``bucket``, ``id``, ``n``, ``most``.

    Put the shingles of all sets in one order, those that nobody shares first, then the
    rare ones. If p shingles of a set of n lie before the first that it has in common
    with a set of m, they have no more than n - p in common; to be alike they need
    percent * (n + m) / (100 + percent). So under its p-th shingle a set need only meet
    sets of ``most`` shingles at most, as it follows from p, and only if their own
    ``most`` allows for it. Where that rules out every other one, there is no key.
    """
    own = sets.join(members.select("id"), "id", "left_semi").dropDuplicates(["id"])
    each = own.select("id", F.explode("shingles").alias("bucket"))
    shared = stored(each.groupBy("bucket").agg(F.count("*").alias("of")).where("of > 1"), "shared")
    common = each.join(shared, "bucket").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("of", "bucket"))).alias("common"))
    # Positions count the shingles that nobody shares; the smallest set that may be alike has percent * n / 100.
    last = F.expr(f"n - (n * {percent} + 99) DIV 100 + 1 - (n - size(common))")
    first = F.slice("common", 1, F.greatest(last, F.lit(0)).cast("int"))
    keys = common.join(members, "id").select("id", "n", (F.col("n") - F.size("common")).alias("alone"), F.posexplode(first).alias("pos", "key"))
    most = F.expr(f"({100 + percent} * (n - alone - pos) - {percent} * n) DIV {percent}")
    keys = stored(keys.select(F.col("key.bucket").alias("bucket"), "id", "n", most.alias("most")), "keys")
    # The smaller set of a pair must be allowed one of its own size.
    small = keys.where("n <= most").groupBy("bucket").agg(F.min("n").alias("least"))
    return keys.join(stored(small, "small"), "bucket").where("least <= most").drop("least")


def _crossing(keys: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with their component, in buckets that may still hold a link between components."""
    named = keys.join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "id")), "named")
    kinds = named.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or(F.col("n") <= F.col("most")).alias("any")
    )
    open_ = kinds.where("low < high AND any").select("bucket")
    return stored(named.join(stored(open_, "crossing"), "bucket", "left_semi"), "open")


def _met_rarely(open_: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Like :func:`_met`, under rare keys; hubs come from the components with the fewest members of a bucket."""
    few = stored(open_.groupBy("bucket", "component").agg(F.count("*").alias("few")), "few")
    first = Window.partitionBy("bucket").orderBy("few", (F.col("n") <= F.col("most")).desc(), "id")
    hubs = open_.join(few, ["bucket", "component"]).withColumn("place", F.row_number().over(first))
    hubs = stored(
        hubs.where(F.col("place") <= count).select(
            "bucket", F.col("id").alias("hub"), F.col("n").alias("hn"), F.col("component").alias("with"),
            F.col("most").alias("hub_most"),
        ), "hubs"
    )
    met = open_.join(hubs, "bucket").where("hn <= most AND n <= hub_most AND component != with")
    return met.select("bucket", "id", "n", "hub", "hn"), hubs


def _without_hubs(open_: DataFrame, hubs: DataFrame) -> DataFrame:
    return open_.join(hubs.select("bucket", F.col("hub").alias("id")), ["bucket", "id"], "left_anti")


def _linked(documents: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``node``, ``component`` of the linked ``classes`` (id, n, d1, bands)."""
    union = F.col("an") + F.col("bn") - F.col("both")
    alike = F.col("both") * 100 >= union * percent
    members = classes.select("id", "n", F.explode("bands").alias("bucket"))
    first = members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("size"))
    hubs = first.where("size > 1").select("bucket", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hn"))
    met = stored(members.join(stored(hubs, "hubs"), "bucket"), "members")
    wanted = classes.select("id", "d1").join(met.select("id").distinct(), "id", "left_semi")
    texts = documents.join(wanted, "id").select("id", "d1", "text").distinct()
    sets = stored(mapped(texts, _sets, "id long, shingles array<long>"), "sets")

    # Step 1: everybody meets the smallest id of the bucket.
    open_, met = met.select("bucket", "id", "n"), met.where("id != hub")
    tested = stored(_tested(_pairs(met, percent), sets), "tested")
    links = tested.where(alike).select("a", "b")
    seen = stored(_measured(met, tested, percent), "seen")
    left = _undecided(open_, hubs, seen, 1 - percent / 100)
    below = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    open_ = stored(_mixed(left, stored(below, "below")), "open")
    # Step 2: those who are left meet the members nearest to it.
    met, hubs = _met(open_, 2)
    done = tested.select("a", "b")
    tested = stored(_tested(_pairs(met, percent).join(done, ["a", "b"], "left_anti"), sets), "tested")
    done = done.union(tested.select("a", "b"))
    links = links.union(tested.where(alike).select("a", "b"))
    groups = stored(components(links), "groups")
    # Step 3: members of buckets that are still mixed meet under rare shingles, until none is undecided.
    left = _mixed(_without_hubs(open_.select("bucket", "id", "n"), hubs), groups)
    left = stored(left.select("id", "n").distinct(), "left")
    if left.isEmpty():
        return groups
    open_, count = _crossing(_rare_keys(left, sets, percent), groups), RARE_HUBS
    while not open_.isEmpty():
        met, hubs = _met_rarely(open_, count)
        tested = stored(_tested(_pairs(met, percent).join(done, ["a", "b"], "left_anti"), sets), "tested")
        done = done.union(tested.select("a", "b"))
        stars = groups.where("node > component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = stored(components(stars.union(tested.where(alike).select("a", "b"))), "groups")
        open_ = _crossing(_without_hubs(open_, hubs).select("bucket", "id", "n", "most"), groups)
        count *= 2
    return groups


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85
) -> DataFrame:
    """Near-duplicate groups: ``id_column``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if their shingle sets have a similarity of ``percent``
    hundredths or more; groups are connected components, named by their smallest
    id, and that document is kept. One row per input row: rows that repeat an id
    and its text get equal results. An id that comes with several texts stands in
    the graph for the one whose set comes first; a row with another text joins the
    group whose set equals its own, or stays alone. Null or
    wordless texts have no shingles and stay alone. A null id is never linked and
    is kept, with a null group.

    Documents with equal sets are one class from the start, whatever their number.
    """
    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = "id long, n long, d1 long, d2 long, bands array<long>"
    bands, rows = banding(percent)
    sketch = stored(mapped(given, functools.partial(_sketch, bands=bands, rows=rows), schema), "sketch")
    named = sketch.where("n > 0 AND id IS NOT NULL")
    text = named.groupBy("id").agg(F.min(F.struct("n", "d1", "d2", "bands")).alias("own"))
    least = F.min(F.struct("id", "bands")).alias("first")
    classes = text.select("id", "own.*").groupBy("n", "d1", "d2").agg(least)
    classes = stored(classes.select("n", "d1", "d2", "first.id", "first.bands"), "classes")
    groups = _linked(given.where("id IS NOT NULL"), classes, percent)
    grouped = classes.select("n", "d1", "d2", "id").join(
        groups.withColumnRenamed("node", "id"), "id", "left"
    )
    grouped = stored(
        grouped.select("n", "d1", "d2", F.coalesce("component", "id").alias("component_id")), "groups"
    )
    found = sketch.select("id", "n", "d1", "d2").join(grouped, ["n", "d1", "d2"], "left")
    alone = F.col("n") == 0
    own = F.col("id").isNull() | alone
    component = F.when(own, F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return found.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85
) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, one per id.

    Rows without an id all stay.
    """
    kept = near_duplicates(docs, id_column, text_column, percent).where("kept").select(id_column)
    named = docs.join(kept.distinct(), id_column, "left_semi").dropDuplicates([id_column])
    return named.select(*docs.columns).unionByName(docs.where(F.col(id_column).isNull()))

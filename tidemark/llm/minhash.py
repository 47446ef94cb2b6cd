"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and components.

Documents of the same shingle set are one class, so thousands of copies cost one signature in the
search. A class enters one bucket per band of its signature. In every bucket the members are first
compared with a centre, a few times over, which ties groups of near copies together. Of the members
of a bucket that are still in different components, blocks of bounded size say by their signatures
which components may be linked at all, in as few pairs as join them. Components that hang together in
this way are a cluster, and only there, again in blocks of bounded size, full shingle sets are compared.
A block returns no more links than it takes to join its components, so a group of copies never gives
all its pairs. A signature only rules pairs out, far below the threshold; links are confirmed on the
full shingle sets.
"""

from __future__ import annotations

import hashlib
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.plans.staging import broadcast_if_small, shuffled, stored

# 32 bands of 4 values: a pair at similarity 0.75 misses every band with probability 5e-6.
SLOTS, ROWS = 128, 4
# Members that are compared at a time, and shingles that may lie in a block of them.
BLOCK, BLOCK_SHINGLES = 1024, 2**21
# Ids of wanted documents that are sent to every task; more of them meet the texts by a shuffle.
SENT_IDS = 500_000
# Elements whose permutations are in memory at a time.
SLICE = 65_536
# Standard deviations by which a signature must fall short before it rules a pair out.
SLACK = 5.0
# Times that the members of a bucket are compared with a centre before the rest is paired in blocks.
ROUNDS = 3

# Fixed values of the splitmix64 generator.
_STEP, _MIX_1, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct word shingles of a text as sorted 64-bit hashes.

    A-Z are lower-cased and words are runs without ASCII white space. A text of fewer words gives
    its whole sequence as one shingle; without words there is none.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    out = np.full(len(parts) - width + 1, width, np.uint64)
    for at in range(width):
        out = _mixed((out ^ hashes[at:at + len(out)]) + _STEP)
    return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash values (documents x slots) as level << 32 | fraction; an empty set stays at the maximum.

    Each element fills one slot per level, in its own random order. A document stops at the level
    that none of its slots exceeds any more.
    """
    values = np.full(len(sets) * slots, np.iinfo(np.uint64).max, np.uint64)
    steps = np.arange(1, slots + 1, dtype=np.uint64) * _STEP
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate([np.empty(0, np.uint64), *sets])
    for start in range(0, len(elements), SLICE):
        element, owner = elements[start:start + SLICE], owners[start:start + SLICE]
        order = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
        row = np.arange(len(element))
        for level in range(slots):
            docs = np.unique(owner)
            full = values.reshape(-1, slots)[docs].max(axis=1) >> np.uint64(32)
            open_docs = np.zeros(len(sets), bool)
            open_docs[docs[full >= level]] = True
            going = open_docs[owner]
            if not going.any():
                break
            element, owner, row = element[going], owner[going], row[going]
            random = _mixed(element + steps[level])
            place = level + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)
            slot = order[row, place].astype(np.int64)
            order[row, place] = order[row, level]
            np.minimum.at(values, owner * slots + slot, np.uint64(level << 32) | (random >> np.uint64(32)))
    return values.reshape(-1, slots)


def _described(batches, words):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        start = 0
        while start < batch.num_rows:
            sets, elements = [], 0
            while start + len(sets) < batch.num_rows and elements < SLICE:
                sets.append(shingles(texts[start + len(sets)].as_py(), words))
                elements += len(sets[-1])
            short = (_mixed(signatures(sets)) & np.uint64(0xFFFF)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [ids.slice(start, len(sets)), pa.array(map(len, sets), pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([row.tobytes() for row in short], pa.binary())],
                ["id", "n", "digest", "signature"])
            start += len(sets)


def _plausible(batches, slots, share):
    """Pairs that neither sizes nor signatures rule out."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, slots) for c in ("sa", "sb"))
        keep = (a == b).sum(axis=1) >= _least(slots, share)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))],
                                         ["a", "b"])


def _least(slots: int, share: float) -> int:
    return ceil(slots * share - SLACK * sqrt(slots * share * (1 - share)))


def _forest(group: pa.Table, percent: int, exact: bool) -> pa.Table:
    """Pairs that join the components of two blocks' members, no more of them than that takes.

    By signatures alone the pairs are of components that may be linked. With ``exact`` they are of
    members that share a band and whose full sets are similar enough.
    """
    ids, sizes, component = (group[c].to_numpy() for c in ("id", "n", "component"))
    short = np.frombuffer(b"".join(group["signature"].to_pylist()), "<u2").reshape(len(ids), -1)
    bands = np.ascontiguousarray(short).view("<u8").reshape(len(ids), -1)
    side, (_, tree) = group["side"].to_numpy(), np.unique(component, return_inverse=True)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right if len(right) else left
    least, found = _least(short.shape[1], percent / 100), []
    sets = [x.values.to_numpy() for x in group["shingles"]] if exact else []
    for i in left:
        others = right[tree[right] != tree[i]]
        others = others[100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])]
        if exact:
            others = others[(bands[others] == bands[i]).any(axis=1)]
        agreed = (short[others] == short[i]).sum(axis=1)
        for j in others[agreed >= least][np.argsort(-agreed[agreed >= least], kind="stable")]:
            if tree[j] == tree[i] or (exact and not _linked(sets[i], sets[j], percent)):
                continue
            tree[tree == tree[j]] = tree[i]
            found.append((ids[i], ids[j]) if exact else (component[i], component[j]))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(pairs.min(axis=1)), "b": pa.array(pairs.max(axis=1))})


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id, kept (BOOLEAN): one row per row of ``docs``.

    Documents are linked if 100 * shared shingles >= ``percent`` * shingles of both. Null, empty and
    blank texts have no shingles and are linked with nothing. Repeated rows are documents of the same
    text. Rows that repeat a key with another text count as one document with either text. A row
    without key is linked with nothing, has no component and is kept. Other columns are not read.
    """
    read = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = stored(read.mapInArrow(lambda rows: _described(rows, words),
                                       "id long, n long, digest binary, signature binary"), "described")
    alike = described.where("n > 0 AND id IS NOT NULL")
    classes = stored(alike.groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("signature").alias("signature")), "classes")

    band = F.explode(F.sequence(F.lit(0), F.lit(SLOTS // ROWS - 1))).alias("band")
    keyed = classes.select("id", "n", "signature", band).select("id", F.xxhash64(
        "band", F.expr(f"substring(signature, band * {2 * ROWS} + 1, {2 * ROWS})")).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("id").alias("size")).where("size > 1")
    members = stored(shuffled(keyed).join(shared, "bucket").select("bucket", "id"), "members")

    def with_signatures(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            known = classes.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("signature").alias(f"s{side}"))
            pairs = pairs.join(shuffled(known), side)
        return pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b", "sa", "sb")

    # Only where rows repeat an id can a set be met twice.
    repeats = not described.groupBy("id").count().where("count > 1").isEmpty()

    def sets_of(ids: DataFrame) -> DataFrame:
        """id, digest, shingles of the documents named; texts are shuffled only if the ids are too many to be sent to them."""
        wanted = broadcast_if_small(stored(ids.distinct(), "wanted"), SENT_IDS)
        sets = shuffled(read).join(wanted, "id").mapInArrow(lambda rows: _sets(rows, words), "id long, digest binary, shingles array<long>")
        return stored(sets.dropDuplicates(["id", "digest"]) if repeats else sets, "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        pairs = broadcast_if_small(pairs)
        for side in ("a", "b"):
            pairs = pairs.join(shuffled(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"s{side}"))), side)
        both = F.size(F.array_intersect("sa", "sb"))
        enough = 100 * both >= percent * (F.size("sa") + F.size("sb") - both)
        return stored(pairs.where(enough).select("a", "b"), "links")

    def ruled_in(pairs: DataFrame) -> DataFrame:
        return stored(with_signatures(pairs.distinct()).mapInArrow(
            lambda rows: _plausible(rows, SLOTS, percent / 100), "a long, b long"), "plausible")

    links = None
    for number in range(ROUNDS):
        found = components(links) if links is not None else None
        open_members = _open(members, found)
        if open_members.isEmpty():
            break
        more = verified(ruled_in(_with_centre(open_members, number)))
        links = more if links is None else links.union(more)
    else:
        open_members = _open(members, components(links))
        may = stored(_across(shuffled(open_members).join(classes.select("id", "n", "signature"), "id"), "bucket", percent, False), "may")
        # Components that may be linked, directly or through others, make up a cluster.
        clusters = components(may).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
        inside = stored(open_members.select("id", "component").distinct().join(clusters, "component"), "inside")
        full = shuffled(inside).join(classes, "id").join(shuffled(sets_of(inside.select("id"))), ["id", "digest"])
        links = links.union(stored(_across(full, "cluster", percent, True), "links"))
    found = components(links) if links is not None else None
    if found is None:
        found = members.select("id", F.col("id").alias("component")).limit(0)
    found = found.withColumnRenamed("id", "member")
    grouped = classes.join(found, classes["id"] == found["member"], "left").select(
        "digest", F.coalesce("component", "id").alias("component_id"))
    out = described.join(grouped, "digest", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _sets(batches, words):
    for batch in batches:
        sets = [shingles(value.as_py(), words).view(np.int64) for value in batch.column(1)]
        ends = np.cumsum([0, *map(len, sets)])
        values = np.concatenate([np.empty(0, np.int64), *sets])
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
            ["id", "digest", "shingles"])


def _open(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """bucket, id, component of the members of buckets that hold more than one component."""
    if found is None:
        return members.select("bucket", "id", F.col("id").alias("component"))
    labelled = stored(members.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return stored(shuffled(labelled).join(mixed.select("bucket"), "bucket"), "open")


def _with_centre(labelled: DataFrame, number: int) -> DataFrame:
    """a, b: every member beside its bucket's centre, if that is of another component.

    The centre is drawn per bucket and round, so in the many buckets that near copies share each
    meets many others, and one link is enough to tie it to the group.
    """
    drawn = F.min(F.struct(F.xxhash64(F.lit(number), "bucket", "id").alias("draw"), "id", "component")).alias("top")
    centres = labelled.groupBy("bucket").agg(drawn).select("bucket", F.col("top.id").alias("centre"), F.col("top.component").alias("main"))
    paired = shuffled(labelled).join(centres, "bucket").where("component != main")
    return paired.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))


def _across(labelled: DataFrame, by: str, percent: int, exact: bool) -> DataFrame:
    """a, b: what ``_forest`` finds among the members of each ``by`` that are in different components.

    The members outside the group's main component are compared with each other and with those inside,
    in blocks; the latter are never compared with each other. Blocks are bounded by members and, where full
    sets lie in them, by shingles.
    """
    weight = F.greatest(F.lit(1 / BLOCK), F.col("n") / BLOCK_SHINGLES) if exact else F.lit(1 / BLOCK)
    sizes = labelled.groupBy(by, "component").agg(F.sum(weight).alias("blocks"))
    counted = sizes.groupBy(by).agg(F.max(F.struct("blocks", "component")).alias("top"), F.sum("blocks").alias("blocks"),
                                    F.count(F.lit(1)).alias("parts")).where("parts > 1")
    counted = counted.select(by, F.col("top.component").alias("main"), F.ceil("top.blocks").cast("int").alias("k_in"),
                             F.greatest(F.ceil(F.col("blocks") - F.col("top.blocks") - 1e-9), F.lit(1)).cast("int").alias("k_out"))
    sides = labelled.join(counted, by).withColumn("inside", F.col("component") == F.col("main"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("inside"), F.col("k_in")).otherwise(F.col("k_out"))).cast("int")
    # Inside members meet every outside block. Outside members meet every inside block, and the outside
    # blocks up to their own as the right side, from their own on as the left.
    place = F.when(F.col("inside"), F.expr("transform(sequence(0, k_out - 1), i -> struct(i AS l, -own - 1 AS r, 1 AS side))")).otherwise(
        F.expr("concat(transform(sequence(0, k_in - 1), i -> struct(own AS l, -i - 1 AS r, 0 AS side)),"
               " transform(sequence(own, k_out - 1), i -> struct(own AS l, i AS r, 0 AS side)),"
               " transform(filter(sequence(0, own), i -> i < own), i -> struct(i AS l, own AS r, 1 AS side)))"))
    kept = [by, "id", "component", "n", "signature", *(["shingles"] if exact else [])]
    spread = sides.withColumn("own", own).select(*kept, F.explode(place).alias("p")).select(*kept, "p.l", "p.r", "p.side")
    return spread.groupBy(by, "l", "r").applyInArrow(lambda group: _forest(group, percent, exact), "a long, b long").distinct()

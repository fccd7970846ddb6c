"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

A document is the set of its word shingles.  Each signature coordinate is the shingle with the least
hash under one hash function, so two documents share a coordinate with the probability of their
Jaccard similarity.  Documents whose similarity reaches 0.8 share at least ``MATCHES`` of the posted
``COORDINATES``, and differ in at most ``FAR`` of the ``BITS`` one-bit coordinates that come beside
them (each of the two bounds holds for all but about one pair in 100,000 at exactly 0.8).

* Documents with equal sets are one class, represented by the smallest id.
* *Prefix:* a class posts itself under its rarest coordinate-value pairs only.  All classes order
  pairs alike (by number of classes, then by value), so two classes that share ``MATCHES`` pairs
  share one of their first ``COORDINATES - MATCHES + 1``.  Passages that many documents share give
  frequent pairs, which stay behind the prefix.
* *Skip:* the lists of frequent pairs are never merged.  Once two classes meet in a prefix list,
  their remaining collisions are counted on the bits.
* *Hubs:* within a list everything is first compared with the list's smallest and largest id, and
  confirmed against the smallest hub it may match.  What one hub links is its group.  Then each class
  is compared with the groups it meets in its lists, from the smaller group to the larger.  A member
  of a group is at most 0.2 from its hub, so a class that is linked to a member is at most 0.4 from the
  hub; what the bits put farther off is done with.  The rest meets the members in blocks.  A list of
  many copies costs its length, not its square, and no pair of unlinked texts leaves a join.
* Links are confirmed on the full sets, and components are taken over the links of all classes.

Defined cases: a null text, or one without words, has an empty set and stands alone; a text with
fewer words than a shingle is one shingle; equal rows (also with equal ids) are equal sets and take
the smallest id; different texts under one id are one document, linked if any of them is; a null id is kept as a row and linked with nothing; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import lower_words, query, small_batches, table
from .graph import components

COORDINATES = 32
MATCHES = 14
BITS = 512
#: Differing bits of two sets at most 0.2, and at most 0.4, apart.
FAR, FAR_FROM_HUB = 84, 146
#: Classes of a list or group that are compared at once.
BLOCK = 256
_LANES = [f"l{i}" for i in range(BITS // 64)]

_SEEDS = np.random.default_rng(20240229).integers(1, 2**32, (2, BITS, 1), dtype=np.uint32)
_XOR, _MUL = _SEEDS[0], _SEEDS[1] | np.uint32(1)


@dataclass(frozen=True)
class Shingling:
    """``width`` words make a shingle; sets are linked from ``threshold`` per cent of their union on."""

    width: int = 5
    threshold: int = 80


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct 64-bit shingle hashes in ascending order, as unsigned integers."""
    tokens = lower_words(text)
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
    size = min(width, n)
    mixed = np.full(n - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= h[k : n - size + 1 + k]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle of each posted coordinate, and one bit of every coordinate's least hash, in 64-bit lanes."""
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(BITS, np.iinfo(np.uint32).max, np.uint32)
    shingles = np.zeros(COORDINATES, np.uint64)
    for start in range(0, len(low), 1024):
        mixed = (low[None, start : start + 1024] ^ _XOR) * _MUL
        at = mixed[:COORDINATES].argmin(axis=1)
        values = mixed.min(axis=1)
        better = (values[:COORDINATES] < least[:COORDINATES]) | (start == 0)
        shingles[better] = hashes[start + at[better]]
        np.minimum(least, values, out=least)
    return shingles, np.packbits(((least >> np.uint32(11)) & np.uint32(1)).astype(np.uint8)).view(np.int64)


SKETCH = "id long, n long, digest string, keys array<long>, lanes array<long>"


def sketches(docs: DataFrame, shingling: Shingling) -> DataFrame:
    """One row per row of (id, text): set size, digest of the set, posting keys, bit lanes."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("digest", pa.string()),
         ("keys", pa.list_(pa.int64())), ("lanes", pa.list_(pa.int64()))]
    )
    coordinate = (np.arange(COORDINATES, dtype=np.uint64)) << np.uint64(58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys, lanes = [], [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), shingling.width)
                sizes.append(len(hashes))
                if not len(hashes):
                    digests.append(None)
                    keys.append(None)
                    lanes.append(None)
                    continue
                digests.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()))
                shingles, bits = signature(hashes)
                keys.append(((shingles >> np.uint64(6)) | coordinate).view(np.int64))
                lanes.append(bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(lanes, pa.list_(pa.int64()))],
                schema=schema,
            )

    return docs.select(F.col("id").cast("long"), "text").mapInArrow(run, SKETCH)


def prefixes(classes: DataFrame) -> DataFrame:
    """Postings (key, id) of each class under its rarest shared keys."""
    posted = classes.select("id", F.explode("keys").alias("key"))
    # A key of one class meets nothing; it only takes a place in that class's prefix.
    shared = stage(posted.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "shared-keys")
    met = posted.join(shared, "key").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("size", "key"))).alias("met")  # at most one per coordinate
    )
    # Under an id with several texts the prefix is the longer for it, never shorter than each text needs.
    alone = F.lit(COORDINATES) - F.size("met")
    room = F.greatest(F.lit(COORDINATES - MATCHES + 1) - alone, F.lit(0))
    listed = met.select("id", F.slice("met", F.lit(1), room).alias("met")).filter(F.size("met") > 0)
    return stage(listed.select(F.explode("met.key").alias("key"), "id"), "postings")


def far(a: str, b: str) -> Column:
    """Number of differing bits."""
    return reduce(add, [F.bit_count(F.col(f"{a}.{lane}").bitwiseXOR(F.col(f"{b}.{lane}"))) for lane in _LANES])


def similar(a: str, b: str, shingling: Shingling) -> Column:
    """Exact: the full sets reach the threshold.  Sizes are compared first."""
    x, y = F.col(f"{a}.set"), F.col(f"{b}.set")
    common = F.size(F.array_intersect(x, y))
    return sizes_fit(a, b, shingling) & (100 * common >= shingling.threshold * (F.size(x) + F.size(y) - common))


def sizes_fit(a: str, b: str, shingling: Shingling) -> Column:
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 100 * F.least(n, m) >= shingling.threshold * F.greatest(n, m)


def full_sets(ids: DataFrame, docs: DataFrame, shingling: Shingling, name: str) -> DataFrame:
    """(id, n, set) of the documents in ``ids``; only their texts become sets."""
    width = shingling.width

    @F.pandas_udf("array<long>")
    def shingle(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).view(np.int64) for t in texts], dtype=object)

    wanted = stage(ids.distinct(), f"{name}-ids")
    sets = docs.join(wanted, "id", "left_semi").select("id", shingle("text").alias("set"))
    return stage(sets.select("id", F.size("set").alias("n"), "set"), f"{name}-sets")


def hub_links(classes: DataFrame, postings: DataFrame, heads: DataFrame, docs: DataFrame, shingling: Shingling) -> DataFrame:
    """(id, hub): each class with one hub it is linked to, if the hub it may match is one."""
    ends = stage(
        postings.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high"), "list-ends"
    )
    star = postings.join(ends, "key").select("id", F.explode(F.array("low", "high")).alias("hub"))
    star = star.filter("id <> hub").distinct().join(heads, "id").alias("x")
    near = star.join(
        heads.alias("h"), F.expr("x.hub = h.id") & sizes_fit("x", "h", shingling) & (far("x", "h") <= FAR)
    )
    # One direction only, so that a group's hub is no member of its own member's group.
    chosen = near.filter("h.id < x.id").groupBy(F.col("x.id").alias("id")).agg(F.min("x.hub").alias("hub"))
    chosen = stage(chosen, "hub-pairs")
    sets = full_sets(chosen.select("id").union(chosen.select("hub")), docs, shingling, "hub")
    left = chosen.join(sets, "id").alias("x")
    return stage(
        left.join(sets.alias("y"), (F.col("x.hub") == F.col("y.id")) & similar("x", "y", shingling)).select("x.id", "hub"),
        "hub-links",
    )


def class_links(classes: DataFrame, docs: DataFrame, shingling: Shingling) -> DataFrame:
    """Links (a, b) that connect whatever classes are similar; pairs in one group are not repeated."""
    postings = prefixes(classes)
    heads = classes.select("id", "n", *[F.col("lanes")[i].alias(lane) for i, lane in enumerate(_LANES)])
    links = hub_links(classes, postings, heads, docs, shingling)

    # Groups: a hub and what it links.  A hub that is itself linked elsewhere is a member there only;
    # its own group then has it as centre, not as member, which the bound of 0.4 allows.
    members = stage(
        classes.select("id").distinct().join(links, "id", "left").select("id", F.coalesce("hub", "id").alias("grp")), "members"
    )
    groups = stage(members.groupBy("grp").agg(F.count("*").alias("members"), F.max(F.col("id") != F.col("grp")).alias("wide")), "groups")
    listed = stage(postings.join(members, "id").join(groups, "grp"), "grouped")
    share = listed.groupBy("key", "grp", "members", "wide").count()
    largest = F.max_by("grp", F.struct("members", "grp")).alias("main")
    lists = stage(
        share.groupBy("key").agg(F.count("*").alias("groups"), F.sum("count").alias("size"), largest).filter("groups > 1"),
        "mixed-lists",
    )
    parts = {
        "own_parts": F.ceil(F.col("size") / BLOCK).cast("int"),
        "all_parts": F.ceil(F.col("groups") / BLOCK).cast("int"),
    }
    # Each class of a list, but for the largest group's, against the larger groups of the list.
    own = listed.join(lists, "key").filter("grp <> main").join(heads, "id").withColumns(parts).withColumns({
        "i": F.pmod(F.xxhash64("id"), F.col("own_parts")).cast("int"),
        "j": F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)),
    })
    hubs = heads.withColumnRenamed("id", "grp")
    whole = stage(share, "shares").join(lists.drop("main"), "key").join(hubs, "grp").withColumns(parts).withColumns({
        "j": F.pmod(F.xxhash64("grp"), F.col("all_parts")).cast("int"),
        "i": F.explode(F.sequence(F.lit(0), F.col("own_parts") - 1)),
    })
    keys = ["key", "i", "j"]
    own = own.select(*keys, "id", "n", "grp", "members", *_LANES).alias("x")
    whole = whole.select(*keys, "n", "grp", "members", "wide", *_LANES).alias("y")
    upward = F.expr("struct(x.members, x.grp) < struct(y.members, y.grp)")
    near = F.expr("y.wide") & (far("x", "y") <= FAR_FROM_HUB) | (far("x", "y") <= FAR) & sizes_fit("x", "y", shingling)
    met = own.join(whole, [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys] + [upward, near])
    met = stage(met.select("x.id", F.col("y.grp").alias("grp")).distinct(), "met-groups")

    # The classes against the members of the groups they met, by bits and then exactly.
    asked = stage(met.groupBy("grp").agg(F.count("*").alias("asking")), "asked-groups")
    against = stage(members.join(asked, "grp").join(groups, "grp"), "asked-members")
    sets = full_sets(met.select("id").union(against.select("id")), docs, shingling, "cross").join(heads.drop("n"), "id")
    parts = {
        "own_parts": F.ceil(F.col("asking") / BLOCK).cast("int"),
        "all_parts": F.ceil(F.col("members") / BLOCK).cast("int"),
    }
    own = met.join(asked, "grp").join(groups, "grp").withColumns(parts).withColumns({
        "i": F.pmod(F.xxhash64("id"), F.col("own_parts")).cast("int"),
        "j": F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)),
    })
    whole = against.withColumns(parts).withColumns({
        "j": F.pmod(F.xxhash64("id"), F.col("all_parts")).cast("int"),
        "i": F.explode(F.sequence(F.lit(0), F.col("own_parts") - 1)),
    })
    keys = ["grp", "i", "j"]
    own = own.select(*keys, "id").join(sets, "id").alias("x")
    whole = whole.select(*keys, "id").join(sets, "id").alias("y")
    crossed = own.join(
        whole,
        [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys]
        + [F.expr("x.id <> y.id"), far("x", "y") <= FAR, similar("x", "y", shingling)],
    )
    crossed = stage(crossed.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "cross-links")
    return links.select(F.col("id").alias("a"), F.col("hub").alias("b")).union(crossed)


def near_duplicates(
    docs: DataFrame, shingling: Shingling = Shingling(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``id``, ``n`` (set size), ``component`` (smallest id reachable)."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stage(sketches(source, shingling), "sketches")
    real = rows.filter("digest IS NOT NULL AND id IS NOT NULL")
    classes = stage(
        real.groupBy("digest").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("lanes").alias("lanes")
        ),
        "classes",
    )
    links = class_links(classes, source, shingling)
    found = stage(components(links), "components")
    roots = classes.select("digest", "id").join(found, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    joined = rows.select("id", "n", "digest").join(stage(roots, "roots"), "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return joined.select("id", "n", component.alias("component"))


@query("op2_minhash")
def op2_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = near_duplicates(docs, Shingling(width=2, threshold=80))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )

"""Near duplicates by bottom-k sketches of word shingles.

One hash function gives every shingle a number; the ``k`` smallest of a document are its sketch. Documents with equal sets fall
together first. Inverted lists of the retained values then generate candidates. A pair at the threshold shares
far more than half of its sketches (more than ``SAFE`` of them but for a chance around 1e-9 per pair at k = 64; always, where a sketch is the whole
set), so it must meet among the rarest ``size - needed + 1`` values of either: only these are listed, which keeps common shingles out
of the lists. Each list links its members to one pivot, so it makes a line of pairs and not a square.

Members of longer lists that are still in different components then meet by their full sets: a pair at the threshold shares one of the rarest values of both sets,
and how many count follows from its two sizes. Groups of texts that are alike but not alike enough have rare values of their own and so make
no pairs, however many there are (lists of up to 64 members just pair what is left).

Each set has a parity of 512 bits: every value turns one over. Where two sets differ in d values their parities differ in d bits at the most, so the joins
drop pairs whose parities are further apart than sets at the threshold can be; none at the threshold is lost. Sets of up to some 1000 values that aren't alike seldom
get past that. The union-sketch estimate drops more pairs that are clearly apart, and full sets decide the rest: 100 * intersection >= percent * union.

Defined cases: null or wordless texts have an empty set and are linked with nothing; a text with fewer words than a shingle has one
shingle of all its words; a null id has n_shingles, a null component and is kept, and links nothing; repeated rows are in one component (all rows
with its id and text are kept); rows with one id and different texts are taken one by one, as nodes of id and checksum; empty tables give an empty result; only id and text are read.
Shingles are compared by 64-bit hashes, equal sets are told by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.arrays import mixed, portions, prefix_hash, span_hash, text_bytes
from tabloom.llm.components import components
from tabloom.llm.workspace import Workspace
from tabloom.scratch import materialize

K = 64
PORTION = 1 << 20  # bytes of text that a task takes apart at once
SAFE = 0.5  # share of its sketch that any partner at 0.8 has too
SENT_IDS = 4_000_000  # numbers that are broadcast at the most (32 MB)
HEADED = 256  # values of a set whose entries carry the rarest ones
SHORT = 64  # members of a list that are paired directly, so each meets 63 others there at the most
WORDS = 8  # of 64 bits in a parity
EPS = 0.3  # what the sketch estimate may be below the threshold: six standard errors at k = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)  # odd


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and n + 1 offsets."""
    body, offsets = text_bytes(texts)
    n = len(texts)
    body = _LOWER[body]
    inside = ~_BREAK[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True  # a text's end ends a word
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    of = np.searchsorted(offsets, start, "right") - 1
    word = mixed(span_hash(prefix_hash(body), start, stop) ^ (stop - start).astype(np.uint64))
    words = np.bincount(of, minlength=n)
    first = np.concatenate([[0], np.cumsum(words)])
    # shingle i covers words i .. i + width - 1 of its text; a short text has one shingle of what there is
    heads = np.maximum(words - width + 1, (words > 0).astype(np.int64))
    owner = np.repeat(np.arange(n), heads)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(heads) - heads, heads) + first[owner]
    code = np.zeros(len(owner), np.uint64)
    left = first[owner + 1] - at
    for j in range(width):
        have = left > j
        code[have] = mixed(code[have] * _STEP + word[at[have] + j])
    order = np.argsort(code)
    small = owner[order].astype(np.uint16) if n < 1 << 16 else owner[order]
    order = order[np.argsort(small, kind="stable")]
    owner, code = owner[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    return code[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=n))])


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def parities(codes: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """64 * WORDS bits for each set of distinct hashes, of which each hash turns one over."""
    n, bits = len(offsets) - 1, 64 * WORDS
    step = 1 << 14  # sets at a time
    parts = []
    for lo in range(0, n, step):
        ends = offsets[lo : lo + step + 1]
        sets = len(ends) - 1
        at = np.repeat(np.arange(sets) * bits, np.diff(ends)) + (mixed(codes[ends[0] : ends[-1]] + _STEP) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
        odd = np.bincount(at, minlength=sets * bits).astype(np.uint8) & 1
        parts.append(np.packbits(odd).view(np.uint64))
    return _lists(np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.arange(n + 1) * WORDS)


def may_be_alike(p, q, n, m, percent: int):
    """Whether two sets of n and m values with parities p and q can reach the threshold, by sizes and by how many values they differ in at least."""
    differ = sum((F.bit_count(F.get(p, F.lit(i)).bitwiseXOR(F.get(q, F.lit(i)))) for i in range(WORDS)), F.lit(0))
    return _alike(n, m, percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def _sketches(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(1), PORTION):
            codes, offsets = shingle_sets(part.column(1), width)
            sizes = np.diff(offsets)
            one, two = mixed(codes ^ np.uint64(0x5BD1E995)), mixed(codes + _STEP)
            total = lambda x: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])[offsets])
            keep = np.minimum(sizes, k)
            ends = np.concatenate([[0], np.cumsum(keep)])
            at = np.arange(ends[-1]) - np.repeat(ends[:-1], keep) + np.repeat(offsets[:-1], keep)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(total(one).view(np.int64)), pa.array(total(two).view(np.int64)), _lists(codes[at], ends), parities(codes, offsets)],
                ["id", "n", "d1", "d2", "sketch", "parity"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(1), PORTION):
            codes, offsets = shingle_sets(part.column(1), width)
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(codes, offsets)], ["id", "codes"])

    return run


def text_tag(text_col: str = "text"):
    """Checksum that tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, k: int = K, tag_col: str | None = None) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept, and the text's checksum if ``tag_col`` names it. ``percent`` must be 80 or more."""
    if percent < 80:
        raise ValueError("the sketches are laid out for similarities of 0.8 and more")
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null")
    if ids.groupBy("id").count().where("count > 1").limit(1).take(1):
        return _by_text(docs, id_col, text_col, width, percent, k, tag_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = _near_dedup(rows, id_col, width, percent, k)
    if tag_col:
        tags = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias(id_col), text_tag(text_col).alias(tag_col))
        out = materialize(out.join(tags, id_col, "left"), "near-dedup-tagged")
    return out


def _by_text(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, k: int, tag_col: str | None) -> DataFrame:
    """Where an id repeats, a node is an id with a text; components are named by their smallest id in the end."""
    tagged = docs.select(F.col(id_col).cast("long").alias("id"), text_tag(text_col).alias("tag"), F.col(text_col).cast("string").alias("text"))
    tagged = tagged.withColumn("node", F.when(F.col("id").isNotNull(), F.xxhash64("id", "tag")))
    texts = tagged.where("id is not null").dropDuplicates(["node"]).select(F.col("node").alias("id"), "text")
    rows = texts.unionByName(tagged.where("id is null").select("id", "text"))
    found = _near_dedup(rows, "node", width, percent, k)
    nodes = found.where("node is not null").select("node", "n_shingles", "component_id")
    named = tagged.where("id is not null").select("id", "tag", "node").join(nodes, "node")
    least = named.groupBy("component_id").agg(F.min(F.struct("id", "tag")).alias("least"))
    # a wordless text is linked with nothing
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("id")).otherwise(F.col("least.id"))
    stays = alone | (F.struct("id", "tag") == F.col("least"))
    known = named.join(least, "component_id").select("id", "n_shingles", component.alias("component_id"), stays.alias("kept"), "tag")
    nulls = found.where("node is null").select(F.col("node").alias("id"), "n_shingles", "component_id", "kept", F.lit(None).cast("long").alias("tag"))
    out = known.unionByName(nulls).withColumnRenamed("id", id_col)
    return materialize(out.withColumnRenamed("tag", tag_col) if tag_col else out.drop("tag"), "near-dedup-result")


def _near_dedup(rows: DataFrame, id_col: str, width: int, percent: int, k: int) -> DataFrame:
    """From (id, text), where one id has one text."""
    keep = Workspace(rows.sparkSession, "near-dedup")
    drawn = keep(rows.mapInArrow(_sketches(width, k), "id long, n long, d1 long, d2 long, sketch array<long>, parity array<long>"), "near-sketches")
    known = drawn.where("id is not null and n > 0")
    # equal sets fall together; their smallest id speaks for them
    classes = keep(known.groupBy("n", "d1", "d2").agg(F.min("id").alias("c")), "near-classes")
    lists = keep(_rare_lists(known, classes, percent, k, keep), "near-lists")
    texts = rows.where("id is not null").withColumnRenamed("id", "c")
    # sketches and parities of the classes in any list
    active = keep(drawn.select(F.col("id").alias("c"), "n", "sketch", "parity").join(lists.select("c").distinct(), "c", "left_semi"), "near-active")
    parity = active.select("c", "parity")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return keep(_confirm(_estimate(pairs, active, percent, k), texts, width, percent, keep), "near-links")

    pairs = keep(_pivot_pairs(lists, percent), "near-pairs")
    links = confirmed(pairs)
    roots = components(links, keep=keep)
    undecided = keep(_undecided(lists, roots), "near-undecided")
    sets = keep(_sets_of(texts, undecided.where("not short").select("c").distinct(), width, keep), "near-open-sets")
    listed = keep(full_lists(sets.select(F.col("id").alias("c"), "codes"), percent, keep), "near-full-lists")
    more = _short_pairs(undecided.join(parity, "c"), percent).union(open_pairs(listed, roots, parity, percent)).distinct()
    rest = keep(more.join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    roots = components(links.union(confirmed(rest)), keep=keep)
    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select("n", "d1", "d2", F.coalesce("component", "c").alias("component_id"))
    out = drawn.join(named, ["n", "d1", "d2"], "left")
    alone = F.col("id").isNull() | (F.col("n") == 0)
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    out = out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
    out = materialize(out, "near-dedup-result")
    keep.close()
    return out


def _rare_lists(known: DataFrame, classes: DataFrame, percent: int, k: int, keep) -> DataFrame:
    """(value, c, n): each class under the rarest values of its sketch that it must share one of, where another class is too.

    Rows are counted, copies included: any order that is the same for all will do. Copies of a set collapse when its values are gathered.
    """
    sized = known.select("d1", "n", F.explode("sketch").alias("value"))
    often = sized.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    size = F.least(F.col("n"), F.lit(k)).cast("int")
    whole = F.col("n") * 100 <= k * percent
    # retained values that any partner shares at least: exact where both sketches are whole sets
    needed = F.when(whole, F.ceil(F.col("n") * percent / 100)).otherwise(F.ceil(size * F.lit(SAFE))).cast("int")
    packed = sized.join(often, "value").groupBy("d1", "n").agg(F.sort_array(F.collect_set(F.struct("often", "value"))).alias("shared"))
    # values that occur once are the rarest of all and take the first places
    places = F.size("shared") - needed + 1
    listed = packed.where(places > 0).select("d1", "n", F.explode(F.slice("shared", F.lit(1), places)).alias("s")).select(F.col("s.value").alias("value"), "d1", "n")
    return _met(listed, keep).join(classes.select("n", "d1", "c"), ["n", "d1"]).select("value", "c", "n")


def _met(listed: DataFrame, keep) -> DataFrame:
    """Lists of two members and more; what is listed is written once and read twice."""
    listed = keep(listed, "near-listed")
    return listed.join(listed.groupBy("value").agg(F.count("*").alias("members")).where("members > 1").select("value"), "value")


def _sets_of(texts: DataFrame, ids: DataFrame, width: int, keep) -> DataFrame:
    """(id, codes): full sets of the texts of ``ids``. Up to ``SENT_IDS`` of them are sent to the texts; beyond that both sides are shuffled."""
    ids = keep(ids, "near-ids")
    asked = F.broadcast(ids) if ids.count() <= SENT_IDS else ids.hint("shuffle_merge")
    return texts.join(asked, "c", "left_semi").select("c", "text").mapInArrow(_sets(width), "id long, codes array<long>")


def _alike(n, m, percent: int):
    """Sizes of sets that can reach the threshold."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _overlap(n, m, percent: int):
    """Smallest intersection of two sets at the threshold."""
    return F.expr(f"cast(({n} + {m}) * {percent}L + {99 + percent} as bigint) div {100 + percent}")


def _pivot_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every member of a list with its smallest one."""
    pivot = lists.groupBy("value").agg(F.min(F.struct(F.col("c").alias("p"), F.col("n").alias("m"))).alias("x"))
    both = lists.join(pivot.select("value", "x.*"), "value")
    return both.where((F.col("c") != F.col("p")) & _alike(F.col("n"), F.col("m"), percent)).select(F.col("p").alias("a"), F.col("c").alias("b")).distinct()


def _labelled(lists: DataFrame, roots: DataFrame) -> DataFrame:
    return lists.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("component", "c")).drop("component")


def _undecided(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of lists with a pair in different components that wasn't compared, which has to be of two that aren't the list's pivot."""
    facts = lists.groupBy("value").agg(F.min("c").alias("p"), (F.count("*") <= SHORT).alias("short"))
    others = _labelled(lists, roots).join(facts, "value").where("c != p")
    apart = others.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("value")
    return others.join(apart, "value", "left_semi").select("value", "c", "n", "root", "short")


def _short_pairs(undecided: DataFrame, percent: int) -> DataFrame:
    """Pairs of lists with up to SHORT members: a few for each."""
    left = undecided.where("short")
    right = left.select("value", F.col("c").alias("d"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("parity").alias("q"))
    alike = may_be_alike(F.col("parity"), F.col("q"), F.col("n"), F.col("m"), percent)
    met = left.join(right, "value").where((F.col("c") < F.col("d")) & (F.col("root") != F.col("other")) & alike)
    return met.select(F.col("c").alias("a"), F.col("d").alias("b"))


def full_lists(sets: DataFrame, percent: int, keep) -> DataFrame:
    """(value, c, n, place, head): each set (c, codes) under its rarest values, with their place in that order.

    ``head`` are these values and one more. It is left out of sets above ``HEADED`` values, as each entry carries it.
    """
    entries = sets.select("c", F.size("codes").alias("n"), F.explode("codes").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    packed = entries.join(often, "value").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("shared"))
    before = F.col("n") - F.size("shared")  # values of this member only
    places = F.floor(F.col("n") * (100 - percent) / 100) + 1 - before
    head = F.when(F.col("n") <= HEADED, F.slice(F.col("shared")["value"], F.lit(1), (places + 1).cast("int")))
    listed = packed.where(places > 0).select("c", "n", before.alias("before"), head.alias("head"), F.posexplode(F.slice("shared", F.lit(1), places.cast("int"))).alias("at", "s"))
    place = (F.col("before") + F.col("at")).cast("long").alias("place")
    return _met(listed.select(F.col("s.value").alias("value"), "c", F.col("n").cast("long").alias("n"), place, "head"), keep)


def open_pairs(listed: DataFrame, roots: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that meet early enough in both orders for their sizes; the smaller set's side is the short one.

    ``parity`` has (c, parity) of every set.

    A pair at the threshold shares two values (or all it needs) of its heads, as these are one longer than it takes to share one; it is emitted at the first of them.
    """
    labelled = listed.join(_labelled(parity, roots), "c")
    near = labelled.where(F.col("place") <= F.col("n") - _overlap("n", "n", percent))
    far = labelled.select("value", F.col("c").alias("d"), F.col("n").alias("m"), F.col("place").alias("spot"), F.col("root").alias("other"), F.col("head").alias("top"), F.col("parity").alias("q"))
    least = _overlap("n", "m", percent)
    common = F.array_intersect("head", "top")
    twice = F.coalesce((F.size(common) >= F.least(least, F.lit(2))) & (F.get(common, F.lit(0)) == F.col("value")), F.lit(True))
    met = near.join(far, "value").where(
        (F.col("root") != F.col("other"))
        & ((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("c") < F.col("d"))))
        & may_be_alike(F.col("parity"), F.col("q"), F.col("n"), F.col("m"), percent)
        & (F.col("place") <= F.col("n") - least)
        & (F.col("spot") <= F.col("m") - least)
        & (F.col("head").isNull() | F.col("top").isNull() | twice)
    )
    return met.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def alike_pairs(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and parities, ``facts`` (c, n, parity), don't put below the threshold."""
    one = facts.select(F.col("c").alias("a"), "n", "parity")
    two = facts.select(F.col("c").alias("b"), F.col("n").alias("m"), F.col("parity").alias("q"))
    return pairs.join(one, "a").join(two, "b").where(may_be_alike(F.col("parity"), F.col("q"), F.col("n"), F.col("m"), percent)).select("a", "b")


def _estimate(pairs: DataFrame, active: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs whose union sketch doesn't put them clearly below the threshold."""
    near = alike_pairs(pairs, active.select("c", "n", "parity"), percent)
    one = active.select(F.col("c").alias("a"), F.col("sketch").alias("s"))
    two = active.select(F.col("c").alias("b"), F.col("sketch").alias("t"))
    # values are unsigned numbers in signed columns
    union = F.transform(F.slice(F.sort_array(F.transform(F.array_union("s", "t"), _flip)), 1, k), _flip)
    shared = F.size(F.array_intersect(union, F.array_intersect("s", "t")))
    met = near.join(one, "a").join(two, "b")
    return met.where(shared >= (percent / 100 - EPS) * F.size(union)).select("a", "b").distinct()


def _flip(x):
    """Signed order of the unsigned number, and back."""
    return x.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int, keep) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    pairs = keep(pairs, "near-likely")
    ids = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    sets = keep(_sets_of(texts, ids, width, keep), "near-sets")
    one = sets.select(F.col("id").alias("a"), F.col("codes").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("codes").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", common.alias("common"), F.size("x").alias("nx"), F.size("y").alias("ny"))
    return met.where(f"100 * common >= {percent} * (nx + ny - common)").select("a", "b").distinct()

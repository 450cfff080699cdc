"""Exact Jaccard join of n-gram sets with set-relation skipping.

Two sets link when 100 * |x & y| >= percent * |x | y|. Equal sets are one set
with its documents. A set is cut by hash value into as many parts as differences
are allowed for its size class, and more, so linked sets share a part that holds
several words; smaller parts, which unrelated sets share, are not listed. Index lists are kept per part position and content: a probe meets
only entries that agree at that position, and every other block of a list is
skipped by its key, whatever single n-grams (a passage in a third of all texts)
the sets have in common. Of its parts a set enters the lists of the rarest ones
only, one more than differences are allowed: the rarest part in which linked sets
agree has at most that many rarer ones in either set. A set whose rarest parts are
its own alone is in no list.

Answers come from set relations. Sets that lists connect are a family, led by
the set that shares most parts with others; it alone is compared with every
other one, which gives the link and the difference of the two sets. All other
pairs of a family are derived from the leader's answers: |y ^ z| follows from the
sizes of the differences to the leader and what these have in common, so pairs
already linked through the leader are skipped, and two sets that both fail it can
link only where the first n-grams of their differences (added before removed)
agree; those pairs are confirmed from the texts. Nothing is sampled or capped; hot
lists cost one row per entry.

Sets and n-grams are compared by 64-bit hash. Documents without words are empty
and linked with nothing; ones with fewer than n words have their whole sequence
as one n-gram. Repeated rows are one set and get the same component. A null key
never is a component's name while another exists. An empty table gives no rows.
"""

from __future__ import annotations

from math import ceil, exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import free_name, row_key, stored
from .tokens import _COEF, U64, Shingles, Words, as_long, mix, text_slices

PERCENT = 90
GRAM = 3
#: Bits of the filter of shared keys that is sent to every task.
MARK_BITS = 1 << 28
#: Parts are ranked by how many of these their texts outnumber.
RANKS = (1, 4, 16, 64, 256)
#: Largest to smallest set of a size class (more where linked sizes may lie further apart).
CLASS_RATIO = 1.3
SPARE_PARTS = 2
#: The share of a set's parts that may be too small to be listed, and the most members asked of a listed part.
SMALL_SHARE, MOST_LISTED = 0.06, 8


def most_differences(a: int, b: int, percent: int) -> int:
    """The largest |x ^ y| of linked sets with a and b members."""
    return (100 - percent) * (a + b) // (100 + percent)


def part_rule(smallest: int, largest: int, percent: int) -> tuple[int, int, int]:
    """(differences allowed, parts, members that a part needs to be listed) of a size class.

    Linked sets agree in all parts but one for each difference. So if fewer parts than
    the others are small, an agreeing part is not, and small parts need not be listed:
    what few members they hold is what unrelated sets may share. The sizes of parts are
    Poisson, which gives the small ones to expect."""
    most = most_differences(largest, largest, percent)

    def small(parts, least):  # of the smallest set's parts
        mean = smallest / parts
        return parts * sum(exp(-mean) * mean**k / factorial(k) for k in range(least))

    for least in range(MOST_LISTED, 0, -1):
        spare = SPARE_PARTS + ceil(2 * small(most + 1 + SPARE_PARTS, least))
        parts = most + 1 + spare
        if least == 1 or spare <= SPARE_PARTS + 2 * SMALL_SHARE * most and small(parts, least) <= 0.75 * spare:
            return most, parts, least
    raise AssertionError


_known: dict = {}  # kept in a worker


def part_rules(bounds: np.ndarray, percent: int) -> np.ndarray:
    """The rules of all classes, a row each."""
    rows = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        at = -(-lo * percent // 100), hi - 1, percent
        if at not in _known:
            _known[at] = part_rule(*at)
        rows.append(_known[at])
    return np.array(rows)


def size_classes(largest: int, percent: int) -> list[int]:
    """Lower bounds of the size classes; sets of linkable sizes are in one class or neighbours."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // percent), int(bounds[-1] * CLASS_RATIO)))
    return bounds


def _part_keys(s: Shingles, rows: np.ndarray, bounds: np.ndarray, percent: int) -> list[tuple[np.ndarray, ...]]:
    """(row, key, small, most) of the parts of the given rows that may be listed, for each class they are in: whether
    the part has fewer members than a listed one needs, and the differences that the class allows."""
    sums = np.zeros(len(s.hash) + 1, U64)
    np.cumsum(mix(s.hash ^ _COEF[9]), out=sums[1:])
    size = np.diff(s.offs)[rows]
    own = np.searchsorted(bounds, size, "right") - 1
    out = []
    for step in (0, 1):
        cls = own + step
        use = np.ones(len(rows), bool) if step == 0 else 100 * size >= percent * bounds[cls]
        r, c = rows[use], cls[use]
        rules = part_rules(bounds, percent)
        r, c = r[rules[c, 0] > 0], c[rules[c, 0] > 0]
        most, parts, least = rules[c].T
        if not len(r):
            continue
        n = s.offs[r + 1] - s.offs[r]
        at = np.repeat(s.offs[r] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        member = np.repeat(np.arange(len(r)), n)
        part = ((s.hash[at] >> U64(32)) * parts[member].astype(U64) >> U64(32)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (member[1:] != member[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        end = np.append(at[first[1:] - 1] + 1, at[-1] + 1)
        m, p = member[first], part[first]
        content = sums[end] - sums[at[first]]
        big = end - at[first] >= least[m]
        listed = np.bincount(m[big], minlength=len(r))
        sparse = parts - listed > parts - most - 1  # more small parts than spare ones: they count as agreement too
        keep = big | sparse[m]
        m, p, content, small = m[keep], p[keep], content[keep], ~big[keep]
        for k in np.flatnonzero(sparse):
            empty = np.setdiff1d(np.arange(parts[k]), p[m == k])
            m, p = np.append(m, np.full(len(empty), k)), np.append(p, empty)
            content, small = np.append(content, np.zeros(len(empty), U64)), np.append(small, np.ones(len(empty), bool))
        key = mix(content + mix((c[m].astype(U64) << U64(32)) + p.astype(U64)))
        out.append((r[m], key, small, most[m]))
    return out


def _rarest(row: np.ndarray, key: np.ndarray, small: np.ndarray, most: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the first most + 1 parts of each row, in an order that all sets share: small parts last, then by rank,
    then by key. Those in which linked sets differ are at most ``most``, so both have the first of the others here."""
    order = np.lexsort((key, rank, small, row))
    new = np.ones(len(order), bool)
    new[1:] = row[order[1:]] != row[order[:-1]]
    first = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[place <= most[order]]


def _sets(n: int):
    def run(batches):
        for batch in batches:
            fp, size = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
            for _, _, data, offs in text_slices(batch.column(1)):
                s = Shingles(Words(data, offs, lower=True), n)
                fp.append(s.fingerprint())
                size.append(np.diff(s.offs))
            yield pa.RecordBatch.from_arrays([batch.column(0), as_long(np.concatenate(fp)), as_long(np.concatenate(size))],
                                             names=["k", "fp", "n"])

    return run


def _listed(col, n: int, percent: int):
    """(rows, keys, small, most, fingerprints of the rows) of the parts of a text column, slice by slice, each set once a slice."""
    for _, _, data, offs in text_slices(col):
        s = Shingles(Words(data, offs, lower=True), n)
        fp = s.fingerprint()
        _, rows = np.unique(fp, return_index=True)
        rows = rows[np.diff(s.offs)[rows] > 0]
        if len(rows):
            bounds = np.array([*size_classes(int(np.diff(s.offs).max()) * 3 + 10, percent)])
            for r, key, small, most in _part_keys(s, rows, bounds, percent):
                yield r, key, small, most, fp


def _key_counts(n: int, percent: int):
    def run(batches):
        for batch in batches:
            keys = np.concatenate([np.zeros(0, U64), *(key for _, key, *_ in _listed(batch.column(0), n, percent))])
            key, count = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([as_long(key), pa.array(count.astype(np.int64))], names=["key", "n"])

    return run


def _rank(key: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
    """How many filters a key may be in, up to the first that it is not in."""
    out, some = np.zeros(len(key), np.int64), np.arange(len(key))
    for bits in marks:
        last = U64(len(bits) * 64 - 1)
        for shift in (U64(0), U64(32)):
            at = (key[some] >> shift) & last
            some = some[((bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)).astype(bool)]
        out[some] += 1
    return out


def _entries(n: int, percent: int, marks):
    """The entries of each set's rarest parts whose key may be among the marked ones."""
    def run(batches):
        for batch in batches:
            for row, key, small, most, fp in _listed(batch.column(0), n, percent):
                rank = _rank(key, marks.value)
                at = _rarest(row, key, small, most, rank)
                at = at[rank[at] > 0]
                yield pa.RecordBatch.from_arrays([as_long(key[at]), as_long(fp[row[at]])], names=["key", "fp"])

    return run


def _marked(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of keys, which are hashes already: 16 bits a key, at most MARK_BITS in all. Only its words come
    to the driver. Where it is too small for the keys more entries pass, and the join drops them."""
    size = 1 << 16
    while size < min(MARK_BITS, 16 * keys.count()):
        size *= 2
    places = F.array(F.col("key").bitwiseAND(F.lit(size - 1)),
                     F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(size - 1)))
    words = (keys.select(F.explode(places).alias("at"))
             .groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
             .toArrow())
    out = np.zeros(size // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(U64)


def _shingles_of(col, n: int) -> list[np.ndarray]:
    out = []
    for _, rows, data, offs in text_slices(col):
        s = Shingles(Words(data, offs, lower=True), n)
        out.extend(s.hash[s.offs[i]:s.offs[i + 1]] for i in range(rows))
    return out


def _linked(both: int, x: int, y: int, percent: int) -> bool:
    return 100 * both >= percent * (x + y - both)


def _compare(n: int, percent: int, above: int | None):
    """(r, y, r_text, y_text) -> size of y, link, size d of the difference, and its head; null where the difference is
    more than ``above`` times the size of y.

    The difference is in order: n-grams that y has and r lacks, then those it lacks. With most the largest difference of
    sets linked with y, what links with y has least = d - most of the difference (for a linked y, d * percent / (100 +
    percent)) in its own; of any order that all differences to r share, the first d - least + 1 of both then meet."""
    names = ["r", "y", "n_y", "linked", "d", "head"]

    def run(batches):
        for batch in batches:
            size, linked, far, head = [], [], [], []
            for x, y in zip(_shingles_of(batch.column(2), n), _shingles_of(batch.column(3), n), strict=True):
                both = np.intersect1d(x, y, assume_unique=True)
                added, removed = np.setdiff1d(y, both, assume_unique=True), np.setdiff1d(x, both, assume_unique=True)
                d = len(added) + len(removed)
                near = _linked(len(both), len(x), len(y), percent)
                least = d * percent // (100 + percent) if near else d - len(y) * (100 - percent) // percent
                first = np.concatenate([added, removed])[:d - max(least, 1) + 1].view(np.int64)
                size.append(len(y))
                linked.append(near)
                far.append(d)
                head.append(first if above is None or d <= above * len(y) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(linked, pa.bool_()),
                 pa.array(far, pa.int64()), pa.array(head, pa.list_(pa.int64()))], names=names)

    return run


def _confirm(n: int, percent: int):
    """(a, b, a_text, b_text) -> those that link."""

    def run(batches):
        for batch in batches:
            x, y = (_shingles_of(batch.column(k), n) for k in (2, 3))
            hit = [_linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent) for a, b in zip(x, y, strict=True)]
            keep = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])

    return run


def _families(lists: DataFrame) -> DataFrame:
    """(fp, r) of every set in a list: lists connect sets to families, led by the set with the most shares in lists."""
    width = lists.groupBy("key").agg(F.count("*").alias("width"), F.min("fp").alias("hub"))
    met = lists.join(width, "key")
    shares = met.groupBy("fp").agg(F.sum("width").alias("shares"))
    ties = met.filter("fp <> hub").select("hub", "fp").distinct()
    family = components(ties, "hub", "fp").withColumnRenamed("node", "fp").join(shares, "fp")
    head = family.groupBy("component").agg(F.max(F.struct("shares", "fp")).alias("top"))
    return family.join(head, "component").select("fp", F.col("top.fp").alias("r"))


def _derived(star: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets of one leader, at least one of which fails it, that its answers allow to link: the heads
    of their differences to it meet often enough, and neither their sizes nor those of the differences are too far apart.

    |y ^ z| is the sum of both differences less twice what they have in common. Of that, all is in both heads but for
    what the head that ends first in the common order leaves out."""
    heads = star.select("r", "y", "n_y", "linked", "d", (F.col("d") - F.size("head")).alias("rest"), F.explode("head").alias("gram"))
    near = (100 - percent) / (100 + percent)
    total = F.col("f.n_y") + F.col("h.n_y")
    # what the heads must have in common, times 2 (100 + percent)
    need = ((F.col("f.d") + F.col("h.d") - 2 * F.greatest("f.rest", "h.rest")) * (100 + percent) - total * (100 - percent))
    # which sides fail the leader is asked of both at once: two equal sides are shuffled once
    return (heads.alias("f").join(heads.alias("h"), ["r", "gram"])
            .filter("f.y <> h.y").filter("case when f.linked then false else f.y < h.y or h.linked end")
            .filter(100 * F.least("f.n_y", "h.n_y") >= percent * F.greatest("f.n_y", "h.n_y"))
            .filter(F.abs(F.col("f.d") - F.col("h.d")) <= total * near + 1)
            .groupBy(F.least("f.y", "h.y").alias("a"), F.greatest("f.y", "h.y").alias("b"))
            .agg(F.count("*").alias("met"), F.min(need).alias("need"))
            .filter(2 * (100 + percent) * F.col("met") >= F.col("need")).select("a", "b"))


def _links(docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between set fingerprints that give the right components."""
    texts = docs.select("text").filter("text is not null")
    # keys alone first: those that stand once, most of them, are not sent again with their sets
    twice = texts.mapInArrow(_key_counts(n, percent), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    twice = stored(twice.filter("n > 1"), "twice")  # a join of two plain shuffles is one whose large keys Spark can split
    marks = docs.sparkSession.sparkContext.broadcast([_marked(twice.filter(F.col("n") > least).select("key")) for least in RANKS])
    met = stored(texts.mapInArrow(_entries(n, percent, marks), "key long, fp long").join(twice.select("key"), "key").distinct(), "met")
    shared = met.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi").select("key")
    lists = stored(met.join(stored(shared, "shared"), "key"), "lists")
    one_row = sets.filter("n > 0").groupBy("fp").agg(F.min("k").alias("k")).join(lists.select("fp").distinct(), "fp")
    content = stored(docs.join(one_row, "k").dropDuplicates(["k"]).select("fp", "text"), "contents")

    def compared(led: DataFrame, above: int | None) -> DataFrame:
        """(r, y) with what _compare says of them; led: (fp, r)."""
        own = content.join(led.filter("fp <> r"), "fp").select("r", F.col("fp").alias("y"), F.col("text").alias("y_text"))
        # stored, so that the join is one of two plain shuffles and a leader of very many sets can be split
        lead = stored(content.join(led.select(F.col("r").alias("fp")).distinct(), "fp").select(
            F.col("fp").alias("r"), F.col("text").alias("r_text")), "leaders")
        return stored(own.join(lead, "r").select("r", "y", "r_text", "y_text").mapInArrow(
            _compare(n, percent, above), "r long, y long, n_y long, linked boolean, d long, head array<long>"), "star")

    def links_of(star: DataFrame) -> DataFrame:
        pairs = stored(_derived(star.filter("head is not null"), percent), "derived")  # before texts go with them
        one, other = (content.select(F.col("fp").alias(c), F.col("text").alias(f"{c}_text")) for c in "ab")
        told = pairs.join(one, "a").join(other, "b").select("a", "b", "a_text", "b_text")
        return star.filter("linked").select(F.col("r").alias("a"), F.col("y").alias("b")).unionByName(
            told.mapInArrow(_confirm(n, percent), "a long, b long"))

    star = compared(stored(_families(lists), "families"), 1)
    # A set that differs from its leader by more than its own size says little about others. Whatever it links with
    # differs from the leader by nearly as much: those sets' lists get a leader each, and all heads are kept.
    rest = star.filter(F.col("d") * percent * 100 > F.col("n_y") * (percent * percent - 100 * (100 - percent)))
    left = lists.join(rest.select(F.col("y").alias("fp")).distinct(), "fp", "left_semi")
    shares = left.join(left.groupBy("key").agg(F.count("*").alias("width")).filter("width > 1"), "key")
    central = shares.groupBy("fp").agg(F.sum("width").alias("shares"))
    top = shares.select("key", "fp").join(central, "fp").groupBy("key").agg(F.max(F.struct("shares", "fp")).alias("top"))
    again = stored(shares.select("key", "fp").join(top.select("key", F.col("top.fp").alias("r")), "key")
                   .filter("fp <> r").select("fp", "r").distinct(), "again")
    return stored(links_of(star), "links").unionByName(stored(links_of(compared(again, None)), "links"))


def _label(rows: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """rows (id, text, k) -> (id, k, fp, n) of every row, and (fp, component) of every set that holds words."""
    sets = stored(rows.select("k", "text").mapInArrow(_sets(n), "k binary, fp long, n long").dropDuplicates(["k"]), "sets")
    member = components(_links(rows.select("k", "text"), sets, n, percent))
    named = stored(rows.select("id", "k").join(sets, "k"), "named")
    classes = (named.filter("n > 0").select("fp").distinct().join(member.withColumnRenamed("node", "fp"), "fp", "left")
               .withColumn("component", F.coalesce("component", "fp")))
    return named, classes


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), row_key(key, text).alias("k"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id): one row per row of docs."""
    named, classes = _label(_rows(docs, key, text), n, percent)
    by_set = named.filter("n > 0").groupBy("fp").agg(F.min("id").alias("least")).join(classes, "fp")
    least = by_set.groupBy("component").agg(F.min("least").alias("component_id"))
    names = by_set.join(least, "component").select("fp", "component_id")
    out = named.join(names, "fp", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the least key, nulls last, and of equal rows one.
    Rows without words are linked with nothing and all stay."""
    k = free_name(docs, "_j_k")
    named, classes = _label(_rows(docs, key, text), n, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "k")).alias("first")
    by_set = named.filter("n > 0").groupBy("fp").agg(first).join(classes, "fp")
    keep = by_set.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.k").alias(k))
    some = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    full = docs.filter(some).withColumn(k, row_key(key, text)).join(keep, k).dropDuplicates([k])
    return full.select(*docs.columns).unionByName(docs.filter(~some))

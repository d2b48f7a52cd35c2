"""Links between near copies, and their components, without emitting all pairs of a group.

A bucket is all ids that share a key. In each of ``LEADERS`` rounds a bucket compares its members with one leader (the first in one of ``ORDERS``
random orders, so that a group of many buckets has several), where each component takes one of the leaders of its buckets. Confirmed links are
contracted to components, which joins a group of n copies by about n comparisons and links. A bucket whose members are in one component is done:
further pairs could only repeat a link. What may still be linked in the others is found exactly:

The buckets whose leaders are in one component form a group with one reference set ``r``, and members are written as differences to
it: ``new`` (not in r) and the number ``lost`` (in r only). For two members, the symmetric difference of their sets is
that of their differences, so with ``c`` common elements in them it has ``new + new' + lost + lost' - 2 c``, which a similarity of
0.8 bounds by a ninth of ``n + n'``. Hence linked members share a new element, or share a lost one, or ``9 (new + lost + new' + lost') <= n + n'``. The
first are met by a join on new elements (a prefix of them is enough, see ``_shared``). The last, and those that one lost
element or equal lost elements make links by counts, are joined by stars (``_stars``), not by all their pairs. For the rest one member
for each component and set of lost elements meets the others on lost elements (``_missing``).

Any ``r`` gives the same links; one like its members gives few pairs to look at. A group takes the set of its leaders' component's
id with the most links; one of over ``CROWD`` members takes what most of a few of them, chosen by hash, have in common.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.llm.common import based, discard, written
from scholarmart.session import shuffles_freed, tasks_for

LEADERS, ORDERS = 3, 8
#: bytes of members whose new elements are joined at a time; their shuffle takes some six times as much
PART = 32 << 20
CROWD, ASKED, WORDS = 64, 15, 16


def components(edges: DataFrame) -> DataFrame:
    """Distributed union-find by alternating large and small stars over ``(a, b)`` long ids.

    Returns ``(id, component)`` for every id of an edge; the component is its smallest id. Every step is a
    min per id and a join, so no component passes through one task as a whole. It ends when every id
    has one neighbour, which is nobody's neighbour in turn.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    earlier = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = written(small.where("a <> b").distinct(), "edges")
        discard(earlier)
        earlier = edges
        roles = edges.select(F.col("a").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("b", F.lit(0), F.lit(1)))
        with shuffles_freed(edges.sparkSession):
            if roles.groupBy("id").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 or child = 1 and parent = 1").isEmpty():
                break
    return based(edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct()), edges)


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links; only the components that these join go through union-find. The table of ``found`` goes when it is replaced."""
    place = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(f"{c}_at"))
    ends = links.join(place("a"), "a", "left").join(place("b"), "b", "left").select(F.coalesce("a_at", "a").alias("a"), F.coalesce("b_at", "b").alias("b"))
    ends = written(ends.where("a <> b").distinct(), "joins")
    if ends.isEmpty():
        discard(ends)
        return found
    joined = components(ends)
    roots = written(joined, "roots")
    discard(ends, joined)
    moved = found.join(roots.select(F.col("id").alias("component"), F.col("component").alias("root")), "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    now = written(moved.union(roots.join(found.select("id"), "id", "left_anti")), "found")
    discard(roots, found)
    return now


def _confirmed(pairs: DataFrame, items: DataFrame, as_set: Callable[[Column], Column]) -> DataFrame:
    """Pairs whose sets are similar; what stands for a set travels, and becomes the set after the joins (or its elements with
    repeats, which an intersection leaves out; ``n`` is the size of the set)."""
    left, right = (items.select(F.col("id").alias(a), F.col("s").alias(s), F.col("n").alias(n)) for a, s, n in (("a", "x", "nx"), ("b", "y", "ny")))
    both = F.size(F.array_intersect(as_set(F.col("x")), as_set(F.col("y")))).cast("long")
    return pairs.distinct().join(left, "a").join(right, "b").where(100 * both >= 80 * (F.col("nx") + F.col("ny") - both)).select("a", "b")


def _bits(elements: str) -> Column:
    """``64 * WORDS`` bits that hashed elements set, for bounds on what two sets have in common."""
    part = lambda own, shift: lambda w: F.filter(own, lambda e: F.shiftrightunsigned(e, shift).bitwiseAND(F.lit(3)) == w)
    bit = lambda e: F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(F.lit(63)).cast("int"))
    word = lambda own: F.aggregate(own, F.lit(0).cast("long"), lambda a, e: a.bitwiseOR(bit(e)))
    quarters = F.transform(F.sequence(F.lit(0), F.lit(WORDS // 4 - 1)), part(elements, 22))  # in two steps an element is looked at 8 times, not 16
    return F.flatten(F.transform(quarters, lambda own: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda w: word(part(own, 20)(w)))))


def _differ(x: str, y: str) -> Column:
    """How many bits one side only has: each stands for an element that is not common."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, c: n + c)


def _sides(near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join of ``near`` with itself, alike but for the names, so that they are one shuffle."""
    left, right = (near.select(*(F.col(c).alias(f"{c}{k}") for c in near.columns)) for k in (1, 2))
    return left, right


def _shared(relative: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """Pairs of different components that share a new element, and whose counts and bits of new elements allow a link.

    A member goes to each of its elements with its bits, so the elements are dealt into ``parts``, of which this is one.

    Linked members have ``2 c >= new + new' + |lost - lost'| - (n + n') / 9`` common new elements, and ``new' >= c``, so
    c >= new - (n + n') / 9 >= new - n / 4. By the pigeonhole principle the first ``n / 4 + 1`` new elements of both,
    in any fixed order, have one in common.
    """
    first = F.slice(F.sort_array("new"), 1, F.floor(F.col("n") / 4).cast("int") + 1)
    near = relative.where("size(new) > 0").select("b", "id", "component", "n", F.size("new").alias("added"), "lost", "bits", F.explode(first).alias("e"))
    near = near.where(F.pmod(F.xxhash64("b", "e"), F.lit(parts)) == part) if parts > 1 else near
    left, right = _sides(near)
    least, room = F.abs(F.col("lost1") - F.col("lost2")), F.col("n1") + F.col("n2")
    may = (F.col("component1") < F.col("component2")) & (9 * (F.abs(F.col("added1") - F.col("added2")) + least) <= room)
    may = may & (9 * (_differ("bits1", "bits2") + least) <= room)
    return left.join(right, (F.col("b1") == F.col("b2")) & (F.col("e1") == F.col("e2"))).where(may).select(F.col("id1").alias("a"), F.col("id2").alias("b"))


def _stars(relative: DataFrame) -> DataFrame:
    """Pairs that join all members whose counts allow a link without a common difference, all of one lost element whose counts
    allow one with no other common difference, and all of equal lost elements whose counts allow one without a common new element.

    These are links by their counts alone, ``w + w' <= 0`` of the members' own ``w``. Whoever has such a link has one to the member of the
    least ``w`` as well, so the pairs with that one, one for each member and kind, join what all pairs would.
    """
    kind = lambda by, e, apart: F.struct(F.lit(by).alias("by"), e.alias("e"), (9 * apart - F.col("n")).alias("w"))
    added, lost = F.size("new"), F.col("lost")
    kinds = F.array(kind("none", F.lit(0).cast("long"), added + lost), kind("all", F.col("side"), added.cast("long")))
    kinds = F.concat(kinds, F.transform("first", lambda e: kind("one", e, added + lost - 1)))
    near = relative.where("4 * size(new) <= n").select("b", "id", "component", F.explode(kinds).alias("k")).select("b", "id", "component", "k.*")
    hubs = near.groupBy("b", "by", "e").agg(F.min_by(F.struct("id", "component", "w"), F.struct("w", "id")).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
    hubs = written(hubs.where("low < high").select("b", "by", "e", "hub"), "hubs")
    return based(near.join(hubs, ["b", "by", "e"]).where("component <> hub.component and w + hub.w <= 0").select(F.col("id").alias("a"), F.col("hub.id").alias("b")), hubs)


def _missing(relative: DataFrame) -> DataFrame:
    """Pairs of different components that share a lost element, no new one, and whose counts and bits allow a link.

    Of the members of one component with equal lost elements the one of the least ``9 new - n`` has a link of this kind wherever
    another has one, so it stands for them. As in ``_shared``, ``new + lost - n / 4`` lost elements at least are common, and the first
    ``n / 4 - new + 1`` of both have one in common.
    """
    near = relative.where("4 * size(new) <= n and lost > 0").withColumn("added", F.size("new"))
    row = F.struct("id", "n", "added", "lost", "first", "lost_bits")
    near = near.groupBy("b", "component", "side").agg(F.min_by(row, F.struct(9 * F.col("added") - F.col("n"), F.col("id"))).alias("p")).select("b", "component", "p.*")
    near = near.withColumn("e", F.explode("first")).drop("first")
    left, right = _sides(near)
    added, room = F.col("added1") + F.col("added2"), F.col("n1") + F.col("n2")
    may = (F.col("component1") < F.col("component2")) & (9 * (added + F.abs(F.col("lost1") - F.col("lost2"))) <= room)
    may = may & (9 * (added + _differ("lost_bits1", "lost_bits2")) <= room)
    return left.join(right, (F.col("b1") == F.col("b2")) & (F.col("e1") == F.col("e2"))).where(may).select(F.col("id1").alias("a"), F.col("id2").alias("b"))


def _open(keys: DataFrame, found: DataFrame | None, turn: int, degrees: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Members with their components, and the buckets of several components with a leader: the first in an order of
    the turn or, with ``degrees``, one of the most links."""
    state = keys.withColumn("component", F.col("id")) if found is None else keys.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rank = F.xxhash64(F.lit(turn), F.pmod("key", F.lit(ORDERS)), "id")
    if degrees is not None:
        state, rank = state.join(degrees, "id", "left"), -F.coalesce("degree", F.lit(0))
    leader = F.min_by(F.struct("id", "n", "component"), F.struct(rank, F.xxhash64("id"), "id"))
    buckets = state.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), leader.alias("leader")).where("low < high")
    return state, written(buckets.select("key", "leader"), "open")


def _references(members: DataFrame, hubs: DataFrame | None, items: DataFrame, as_set: Callable[[Column], Column]) -> DataFrame:
    """``of, r``: a set for each group."""
    sizes = written(members.groupBy("of").count(), "sizes")
    small = sizes.where(F.col("count") <= CROWD).select("of")
    small = small.select("of", F.col("of").alias("id")) if hubs is None else small.join(hubs, "of", "left").select("of", F.coalesce("hub", "of").alias("id"))
    own = small.join(items, "id").select("of", F.array_distinct(as_set(F.col("s"))).alias("r"))
    asked = members.join(sizes.where(F.col("count") > CROWD), "of").withColumn("turn", F.row_number().over(Window.partitionBy("of").orderBy(F.xxhash64("id"), "id"))).where(F.col("turn") <= ASKED)
    common = asked.select("of", "id").join(items, "id").select("of", F.explode(F.array_distinct(as_set(F.col("s")))).alias("e")).groupBy("of", "e").count().where(2 * F.col("count") > ASKED)
    crowds = sizes.where(F.col("count") > CROWD).select("of").join(common.groupBy("of").agg(F.collect_list("e").alias("r")), "of", "left")
    return based(own.union(crowds.select("of", F.coalesce("r", F.array().cast("array<long>")))), sizes)


def link(keys: DataFrame, items: DataFrame, as_set: Callable[[Column], Column] = lambda s: s) -> DataFrame:
    """Components of the ids in ``keys(key, id, n)`` that share a key and whose sets have a similarity of 0.8 or more.

    ``items(id, s)`` holds the sets as arrays of longs, or something shorter of which ``as_set`` makes them; ``n`` is the size
    of the set. Where ``items`` has ``n`` too, arrays may repeat elements. Returns ``(id, component)`` for linked ids only.
    """
    edges = found = degrees = None
    links = []
    items = items if "n" in items.columns else items.withColumn("n", F.size(as_set(F.col("s"))).cast("long"))

    def add(new: DataFrame) -> None:
        nonlocal edges, found
        new = written(new.select("a", "b"), "links")
        links.append(new)
        if new.isEmpty():
            return
        edges = new if edges is None else edges.union(new)
        found = components(new) if found is None else _merged(found, new)

    for turn in range(LEADERS):
        state, buckets = _open(keys, found, turn)
        inside = state.join(buckets, "key").where("component <> leader.component and 5 * least(n, leader.n) >= 4 * greatest(n, leader.n)")
        # one leader for each component: more could hardly tell more, and what they miss is found below
        chosen = inside.groupBy("component").agg(F.min_by(F.struct("id", F.col("leader.id").alias("to")), F.struct(F.xxhash64(F.lit(turn), "leader.component"), F.xxhash64("id", "leader.id"))).alias("p"))
        add(_confirmed(chosen.select(F.col("p.id").alias("a"), F.col("p.to").alias("b")), items, as_set))
        discard(buckets)
    degrees = None if edges is None else written(edges.groupBy(F.col("b").alias("id")).agg(F.count("*").alias("degree")), "degrees")

    state, buckets = _open(keys, found, LEADERS, degrees)
    members = written(state.join(buckets, "key").select(F.col("leader.component").alias("of"), "id", "component", "n").distinct(), "members")
    hubs = None if degrees is None else degrees.join(found, "id").groupBy(F.col("component").alias("of")).agg(F.max_by("id", F.struct("degree", "id")).alias("hub"))
    asked = _references(members, hubs, items, as_set)
    references = written(asked, "references")
    discard(asked, buckets, degrees)
    relative = members.join(items.drop("n"), "id").join(references, "of").select(F.col("of").alias("b"), "id", "component", "n", as_set(F.col("s")).alias("s"), "r")
    relative = relative.select("b", "id", "component", "n", F.array_except("s", "r").alias("new"), F.sort_array(F.array_except("r", "s")).alias("gone"))
    first = F.slice("gone", 1, F.greatest(F.floor(F.col("n") / 4).cast("int") - F.size("new") + 1, F.lit(0)))
    lost = {"lost": F.size("gone").cast("long"), "side": F.xxhash64("gone"), "first": first, "bits": _bits("new"), "lost_bits": _bits("gone")}
    relative = written(relative.withColumns(lost).drop("gone"), "relative")
    discard(members, references)
    stars = _stars(relative)
    add(_confirmed(stars, items, as_set))
    discard(stars)
    if found is not None:  # what is joined now needs no further pairs
        before = relative
        relative = written(before.join(found.withColumnRenamed("component", "now"), "id", "left").withColumn("component", F.coalesce("now", "component")).drop("now"), "relative")
        discard(before)
    parts = tasks_for(relative, each=PART, least=1)
    pairs = [written(_missing(relative).distinct(), "pairs"), *(written(_shared(relative, part, parts).distinct(), "pairs") for part in range(parts))]
    discard(relative)
    add(_confirmed(reduce(DataFrame.union, pairs), items, as_set))
    discard(*pairs, *links)
    return found if found is not None else keys.sparkSession.createDataFrame([], "id long, component long")

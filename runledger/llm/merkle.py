"""Merkle manifest of a table: every row a leaf, a tree for each group of rows, one root.

Leaves of a group stand in the order of their ids, and no leaf is sorted to find out where.
Each group's ids make a bitmap: 64-bit words, those without an id left out, merged from all
tasks by bit_or. A directory of counts gives the rows before each word, so the place of a leaf
is the count of its word plus the bits below its own. Leaves then go to slot arrays, keyed by
group and place, of ``CHUNK`` leaves at most; an array is reduced by ``CHUNK_LEVELS`` levels in
one task and its top is a node of the next round, so a tree of a billion leaves takes four
rounds and no task holds more than an array, however large the group.

The siblings of a leaf are read from its array and, above, from those of its array's top.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import attach, written
from runledger.llm.running import running_totals

ARITY = 3
CHUNK_LEVELS = 6
CHUNK = ARITY**CHUNK_LEVELS  # leaves or nodes of a slot array
MOST_LEVELS = 39  # 3 ** 39 is the largest power of 3 that a long holds

# A group is known by these two, never NULL.
GROUP = ["_none", "_group"]
# Words of a bitmap hold 64 ids. Counts are summed in steps of at most 2 ** 16 entries: the
# words of a container, its containers, and so on.
STEPS = (10, 16, 16)
NO_ID = -(1 << 57) - 1  # the word of rows without an id, before all others

PATH = "array<struct<left:string,right:string>>"


def encoded(column: Column | str) -> Column:
    """A value as text that no other value has: ``-`` for NULL, else its UTF-8 length, a
    colon and the value."""
    column = F.col(column) if isinstance(column, str) else column
    text = column.cast("string")
    full = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(column.isNull(), "-").otherwise(full)


def leaf_digest(*columns: Column | str) -> Column:
    """The leaf of a row: hex sha256 of its encoded values."""
    return F.sha2(F.concat(*(encoded(c) for c in columns)), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256)
    )


def path_digest(path: Column) -> Column:
    """Hex sha256 of all siblings on a path, in order."""
    steps = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(steps, ""), 256)


def _height(nodes: Column) -> Column:
    """Levels above that many leaves."""
    powers = F.array(*(F.lit(ARITY**k).cast("long") for k in range(MOST_LEVELS + 1)))
    return F.size(F.filter(powers, lambda p: p < nodes))


def _starts(entries: DataFrame, steps: Sequence[int]) -> DataFrame:
    """``entries`` (a group, ``at``, ``rows``) with ``start``, the rows of its group before it.
    Sums run over the entries of one parent, then over the parents."""
    if not steps:
        before = Window.partitionBy(*GROUP).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        return entries.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    entries = entries.withColumn("_parent", F.shiftright("at", steps[0]))
    within = Window.partitionBy(*GROUP, "_parent").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parents = entries.groupBy(*GROUP, F.col("_parent").alias("at")).agg(F.sum("rows").alias("rows"))
    above = _starts(parents, steps[1:]).select(
        *GROUP, F.col("at").alias("_parent"), F.col("start").alias("_above")
    )
    entries = entries.withColumn("_before", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    return entries.join(above, [*GROUP, "_parent"]).withColumn(
        "start", F.col("_above") + F.col("_before")
    ).drop("_parent", "_above", "_before")


def bitmap_index(leaves: DataFrame) -> DataFrame:
    """The words of the groups' bitmaps (``at``, ``bits``), with the rows that have ids in them
    (``rows``) and the rows of the group before them (``start``)."""
    words = leaves.groupBy(*GROUP, F.col("_word").alias("at")).agg(
        F.bit_or("_bit").alias("bits"), F.count("*").alias("rows")
    )
    return _starts(written(words, "words"), STEPS)


def _crowded_places(crowded: DataFrame, ties: list[str]) -> DataFrame:
    """Places of rows in words with repeated ids or none: rows follow each other by id and
    ``ties``; rows that are equal in these are counted, not ordered."""
    keys = [*GROUP, "_word", "_left", "start"]
    same = crowded.groupBy(*keys, *ties).agg(F.count("*").alias("_n"))
    ranked = running_totals(same, [*GROUP, *ties], {"_upto": "_n"})
    ranked = written(ranked.withColumn("_from", F.col("_upto") - F.col("_n")), "crowded")
    first = ranked.groupBy(*GROUP, "_word").agg(F.min("_from").alias("_first"))
    ranked = attach(ranked, first, [*GROUP, "_word"], ["_upto"], "inner")
    # Equal rows are multiplied in pieces, so that no task makes all of a large number.
    step = F.lit(CHUNK).cast("long")
    pieces = ranked.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, step)))
    each = F.sequence("_piece", F.least(F.col("_piece") + step, "_n") - 1)
    return pieces.repartition("_upto", "_piece").withColumn("_k", F.explode(each)).select(
        *GROUP, "_left", (F.col("start") + F.col("_from") - F.col("_first") + F.col("_k")).alias("_at"), *ties
    )


def _parents(nodes: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, ARITY), ""), 256))


def _slot_arrays(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Slot arrays of nodes and the levels above them, up to ``CHUNK_LEVELS`` or the top."""
    slot = F.struct(
        (F.col("_at") % CHUNK).cast("int").alias("slot"), F.col("_digest").alias("digest"), *carried
    )
    arrays = nodes.groupBy(*GROUP, "_left", F.expr(f"_at div {CHUNK}").alias("_chunk")).agg(
        F.sort_array(F.collect_list(slot)).alias("slots")
    )
    climbs = F.filter(
        F.array(*(F.lit(k) for k in range(1, CHUNK_LEVELS + 1))), lambda k: k <= F.col("_left")
    )
    levels = F.aggregate(
        climbs, F.array(F.transform("slots", lambda s: s["digest"])),
        lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))),
    )
    return written(arrays.withColumn("levels", levels), "slots")


def _climb(nodes: DataFrame, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of each round, and the root of each group."""
    rounds = [_slot_arrays(nodes, carried)]
    top = F.element_at(F.element_at("levels", -1), 1).alias("_digest")
    while not (more := rounds[-1].where(F.col("_left") > CHUNK_LEVELS)).isEmpty():
        rounds.append(_slot_arrays(more.select(
            *GROUP, (F.col("_left") - CHUNK_LEVELS).alias("_left"), F.col("_chunk").alias("_at"), top
        ), []))
    done = [r.where(F.col("_left") <= CHUNK_LEVELS).select(*GROUP, top) for r in rounds]
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return rounds, roots


def _path(levels: Column, slot: Column) -> Column:
    """Siblings of a slot on the levels of its array."""
    def siblings(nodes: Column, level: Column) -> Column:
        at = (slot / F.pow(F.lit(float(ARITY)), level)).cast("int")
        start = at - at % ARITY
        return F.struct(
            F.array_join(F.slice(nodes, start + 1, at - start), "").alias("left"),
            F.array_join(F.slice(nodes, at + 2, start + ARITY - 1 - at), "").alias("right"),
        )

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), siblings)


def _descend(rounds: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """All leaves with their siblings: those of their array, then those of its top. ``tops``
    has each group's height, ``_subroot`` and the path from there."""
    ends = F.floor(F.greatest(F.col("_height") - 1, F.lit(0)) / CHUNK_LEVELS)
    upper = None
    for k in reversed(range(len(rounds))):
        ended = tops.where(ends == k).select(
            *GROUP, F.lit(0).cast("long").alias("_chunk"), "_subroot", F.col("path").alias("_upper")
        )
        if upper is not None:
            ended = ended.unionByName(upper.select(
                *GROUP, F.col("_place").alias("_chunk"), "_subroot", F.col("path").alias("_upper")
            ))
        arrays = attach(rounds[k], written(ended, "paths"), [*GROUP, "_chunk"], ["_left"], "inner")
        slots = F.transform("slots", lambda s: F.struct(
            (F.col("_chunk") * CHUNK + s["slot"]).alias("_place"), s["digest"].alias("_digest"),
            *(s[c].alias(c) for c in (carried if k == 0 else [])),
            F.concat(_path(F.col("levels"), s["slot"]), "_upper").alias("path"),
        ))
        upper = arrays.select(*GROUP, "_subroot", F.inline(slots))
    return upper


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    id_col: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A row for each row of ``docs``: ``id``, ``group`` (as text), ``place`` (in its group,
    from 0), ``leaf``, ``subroot`` (of its group), ``root``, ``path`` (for each level up to the
    root the sibling digests to the left and right, as texts) and the columns of ``carry``,
    texts computed from the row. Digests are lowercase hex.

    A leaf is the digest of ``fields``. Leaves of a group ascend by id, rows without one come
    first; rows that share an id ascend by leaf and then by what they carry. A NULL group is a
    group of its own, before all others, which ascend bytewise. While a tree has more than one
    node, every three consecutive ones, or what is left of them, become their digest. Texts may
    be NULL, empty or long. An empty table gives an empty manifest. Other columns of ``docs``
    are not read, whatever their names."""
    carry = dict(carry or {})
    # Digests as bytes take half the room.
    leaves = written(docs.select(
        F.col(group_col).isNull().alias("_none"),
        F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("_group"),
        F.col(id_col).cast("long").alias("_id"),
        F.unhex(leaf_digest(*fields)).alias("_leaf"),
        *(c.alias(f"_carry_{name}") for name, c in carry.items()),
    ), "leaves")
    spark = leaves.sparkSession
    carried = ["_id", *(f"_carry_{name}" for name in carry)]
    low = F.col("_id").bitwiseAND(F.lit(63)).cast("int")
    keyed = leaves.withColumns({
        "_word": F.coalesce(F.shiftright("_id", 6), F.lit(NO_ID)),
        "_bit": F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), low), F.lit(0).cast("long")),
    })
    words = bitmap_index(keyed)
    totals = words.groupBy(*GROUP).agg(F.sum("rows").alias("_rows"))
    totals = written(totals.withColumn("_height", _height(F.col("_rows"))), "groups")
    words = attach(words, totals.select(*GROUP, F.col("_height").alias("_left")), GROUP, ["at"], "inner")
    words = written(words.withColumn("crowded", F.col("rows") != F.bit_count("bits")), "bitmaps")

    at = attach(
        keyed, words.withColumnRenamed("at", "_word"), [*GROUP, "_word"], ["_leaf"], "inner"
    )
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), low))
    ties = ["_id", "_leaf", *carried[1:]]
    places = at.where(~F.col("crowded")).select(
        *GROUP, "_left", (F.col("start") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("_at"), *ties
    )
    if not words.where("crowded").isEmpty():
        places = places.unionByName(_crowded_places(at.where("crowded"), ties))
    nodes = places.withColumn("_digest", F.lower(F.hex("_leaf"))).drop("_leaf")
    rounds, subroots = _climb(nodes, carried)

    # The groups' own tree: its leaves are the subroots, in the order of the groups.
    groups = subroots.join(totals.select(*GROUP, "_height"), GROUP)
    groups = groups.withColumns({"_some": ~F.col("_none"), "_one": F.lit(1).cast("long")})
    groups = written(running_totals(groups, ["_some", "_group"], {"_upto": "_one"}), "subroots")
    many = groups.count()
    height = next(k for k in range(MOST_LEVELS + 1) if ARITY**k >= many)
    single = [F.lit(False).alias("_none"), F.lit("").alias("_group")]
    upper, top = _climb(groups.select(
        *single, F.lit(height).alias("_left"), (F.col("_upto") - 1).alias("_at"), "_digest",
        F.col("_none").alias("_of_none"), F.col("_group").alias("_of"),
        F.col("_height").alias("_of_height"),
    ), ["_of_none", "_of", "_of_height"])
    found = top.first()
    root = found["_digest"] if found else None
    one = spark.createDataFrame(
        [(False, "", height, root, [])], f"_none boolean, _group string, _height int, _subroot string, path {PATH}"
    )
    tops = _descend(upper, one, ["_of_none", "_of", "_of_height"]).select(
        F.col("_of_none").alias("_none"), F.col("_of").alias("_group"),
        F.col("_of_height").alias("_height"), F.col("_digest").alias("_subroot"), "path",
    )
    return _descend(rounds, written(tops, "tops"), carried).select(
        F.col("_id").alias("id"),
        F.when(~F.col("_none"), F.col("_group")).alias("group"),
        F.col("_place").alias("place"),
        F.col("_digest").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        "path",
        *(F.col(f"_carry_{name}").alias(name) for name in carry),
    )

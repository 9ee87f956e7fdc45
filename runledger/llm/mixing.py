"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, as often over as it needs. A document's
virtual finish time is the source's tokens up to and with it divided by the source's target;
served by finish time, the sources advance side by side in proportion to their targets. The
queue is range-sorted over the whole corpus and cut where the budget is used up.

Only ids, sources and sizes are sorted, never texts. Running totals are kept over ranges of
rows (``running_totals``), so a source with a large share of all rows is spread like the
others.

Defined results: NULL and empty texts have size 0 and are taken 0 words; documents without a
source form a source of their own, last in order. Repeated rows queue each for itself. Ties are
broken by a hash of id and text. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import written
from runledger.llm.running import running_totals
from runledger.operators.skew import fits_broadcast

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3


def word_count(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """``sources`` with weights 1, 2, ... ``cycle``, repeating, by code point of the source
    and NULL last."""
    ranked = running_totals(
        sources.withColumns({"_none": F.col("source").isNull(), "_one": F.lit(1)}),
        ["_none", "source"], {"_rank": "_one"},
    )
    return ranked.withColumn("weight", ((F.col("_rank") - 1) % cycle + 1).cast("double")).drop(
        "_none", "_one", "_rank"
    )


def fair_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target``: the total of all sizes shared
    by weight, none above ``max_epochs`` times its size, the excess reshared until none is
    above. Each round is one sum over the sources; a source once capped stays so."""
    cap = F.col("source_size") * float(max_epochs)
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(full, cap)).alias("caps"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
            F.count_if(full).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["weights"]:
            break
        capped = row["capped"]
        level = (total - (row["caps"] or 0.0)) / row["weights"]
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weigh=cyclic_weights,
    max_epochs: int = MAX_EPOCHS,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 7,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key`` (hash of its text), ``size`` in words,
    ``source``, ``source_size``, ``target`` of its source, ``copies`` taken, ``taken`` words and
    ``first_place`` (words of the mix up to its first copy; NULL if not taken).

    ``weigh`` adds a positive ``weight`` to a table of ``source`` and ``source_size``. The
    budget is the total size of all documents. Whole documents are taken, so a source misses
    its target by one document at most."""
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(text).alias("text_key"),
            F.xxhash64(F.col(doc_id), F.lit(seed)).alias("_shuffled"),
            # Only rows equal in id and text can tie; any order of them gives the same mix.
            F.rand(seed).alias("_tie"),
            F.col(source).isNull().alias("_none"),
            F.lit(1).alias("_one"),
        ),
        "sizes",
    )
    sources = written(
        weigh(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources"
    )
    targets = fair_targets(sources, max_epochs).withColumn("_none", F.col("source").isNull())
    targets = running_totals(targets, ["_none", "source"], {"_upto": "source_size"})
    targets = written(targets.drop("_none"), "targets")

    order = ["_none", "source", "_shuffled", "doc_id", "text_key", "_tie"]
    queued = running_totals(rows, order, {"_all": "size", "_row": "_one"})
    # The words of a source before a document follow from the words of all before it.
    by_source = targets.select(F.col("source").alias("_of"), "source_size", "target", "_upto")
    if fits_broadcast(by_source):
        by_source = F.broadcast(by_source)
    queued = written(
        queued.join(by_source, F.col("source").eqNullSafe(F.col("_of")), "left")
        .withColumn("_done", F.col("_all") - (F.col("_upto") - F.col("source_size")))
        .select("_row", "doc_id", "text_key", "size", "source", "source_size", "target", "_done"),
        "queue",
    )
    copies = queued.where((F.col("size") > 0) & (F.col("target") > 0)).withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    )
    finish = F.col("_epoch") * F.col("source_size") + F.col("_done")
    # A source is served until its target is reached: documents that begin later stay out.
    served = copies.where(finish - F.col("size") < F.col("target")).select(
        "_row", "size", (finish / F.col("target")).alias("_finish")
    )
    budget = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    placed = running_totals(served, ["_finish", "_row"], {"_place": "size"})
    taken = (
        placed.where(F.col("_place") <= budget)
        .groupBy("_row")
        .agg(F.count("*").alias("copies"), F.min("_place").alias("first_place"))
    )
    out = queued.join(taken, "_row", "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("_row", "_done")

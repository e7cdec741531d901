"""Both models' quality in each group of several segments, gaps to the whole, adverse impact, and the checks on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import ratio
from creditloom.operators.metrics import discrimination_of_counts

ALL = "(all)"
MISSING = "(missing)"


def computable(segments: Mapping[str, str], columns: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
    """Segments (name -> column) that a table with these columns can tell apart, and those that it cannot."""
    here = {name: column for name, column in segments.items() if column in columns}
    if not here:
        raise ValueError(f"none of the segments can be computed; missing columns: {sorted(set(segments.values()))}")
    return here, {name: column for name, column in segments.items() if name not in here}


def segment_table(rows: DataFrame, segments: Mapping[str, str], models: Mapping[str, tuple[str, str]], y: str, split: str = "split", least: int = 500, reject_above: float = 0.1, z_limit: float = 2.0) -> DataFrame:
    """One row a split, model, segment and group, and one for all rows of each: size, bad rate, calibration, declined share,
    AUC, Gini, KS, gaps to all rows, and the ratio of the accepted share to that of the most accepted group.

    ``models`` names each model's columns of risk and PD. Groups of fewer than ``least`` rows, and those of one outcome,
    have no AUC, Gini and KS (``note`` says why), and small ones are no measure of the most accepted. Rows are reduced to
    counts by score once, for all segments and models together; everything else works on these counts."""
    each = F.array(*(F.struct(F.lit(m).alias("model"), F.col(risk).alias("s"), F.col(pd).alias("pd")) for m, (risk, pd) in models.items()))
    named = [F.struct(F.lit(ALL).alias("segment"), F.lit(ALL).alias("grp"))] + [F.struct(F.lit(n).alias("segment"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("grp")) for n, c in segments.items()]
    long = rows.where(F.col(y).isNotNull()).select(F.col(split).alias("split"), F.col(y).alias("y"), F.explode(each).alias("_m"), F.array(*named).alias("_g")).select("split", "y", "_m.*", F.explode("_g").alias("_g")).select("split", "y", "model", "s", "pd", "_g.*")
    by = ["split", "model", "segment", "grp"]
    cells = long.groupBy(*by, "s", "pd").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("bad"))
    n, pd = F.col("n"), F.col("pd")
    sums = cells.groupBy(*by).agg(F.sum("n").alias("rows"), F.sum("bad").alias("bads"), F.sum(n * pd).alias("expected_bads"), F.sum(n * pd * (1 - pd)).alias("variance"), F.sum(F.when(pd > reject_above, n).otherwise(0)).alias("rejected"))
    counts = cells.where("s IS NOT NULL").groupBy(*by, "s").agg(F.sum("bad").alias("bad"), F.sum(F.col("n") - F.col("bad")).alias("good"))
    told = sums.join(discrimination_of_counts(counts, by).select(*by, "auc", "gini", "ks"), by, "left")
    note = F.when(F.col("rows") < least, "few rows").when((F.col("bads") == 0) | (F.col("bads") == F.col("rows")), "one outcome").otherwise("")
    z = (F.col("bads") - F.col("expected_bads")) / F.sqrt(F.nullif("variance", F.lit(0.0)))
    told = told.select(
        *by, F.col("rows").alias("n"), "bads", ratio("bads", "rows").alias("bad_rate"), ratio("expected_bads", "rows").alias("mean_pd"), ratio("bads", "expected_bads").alias("ratio"), z.alias("calibration_z"),
        F.when(z > z_limit, "pd too low").when(z < -z_limit, "pd too high").otherwise("").alias("calibration_flag"), ratio("rejected", "rows").alias("reject_rate"), note.alias("note"), *(F.when(note == "", F.col(c)).alias(c) for c in ("auc", "gini", "ks")),
    )
    # the row of all rows stands in every segment; the windows then run over groups, which are few
    told = told.withColumn("segment", F.explode(F.when(F.col("segment") == ALL, F.array(*map(F.lit, segments))).otherwise(F.array("segment"))))
    block = Window.partitionBy("split", "model", "segment")
    whole = lambda c: F.max(F.when(F.col("grp") == ALL, F.col(c))).over(block)
    member = F.col("grp") != ALL
    most = F.max(F.when(member & (F.col("n") >= least), 1 - F.col("reject_rate"))).over(block)
    gaps = {f"{c}_gap_vs_all": F.when(member, F.col(c) - whole(c)) for c in ("auc", "gini", "ks")}
    return told.withColumns({"share": ratio("n", whole("n")), **gaps, "reject_rate_vs_all": F.when(member, F.col("reject_rate") - whole("reject_rate")), "adverse_impact_ratio": F.when(member & (most > 0), (1 - F.col("reject_rate")) / most)})


def segment_checks(table: DataFrame, missing: Mapping[str, str], banded: str | None = None, model: str | None = None) -> DataFrame:
    """(check, split, segment, ok): the groups of a segment make up its split; along the bands of segment ``banded``, named so
    that they sort from the riskiest, ``model``'s bad rate does not rise; a segment that could not be computed has failed."""
    one = F.col("grp") != ALL
    sums = table.groupBy("split", "model", "segment").agg(F.sum(F.when(one, F.col("n"))).alias("parts"), F.max(F.when(~one, F.col("n"))).alias("whole"))
    out = sums.groupBy("split", "segment").agg(F.bool_and(F.col("parts") == F.col("whole")).alias("ok")).select(F.lit("groups make up the split").alias("check"), "split", "segment", "ok")
    if banded is not None:
        before = F.lag("bad_rate").over(Window.partitionBy("split").orderBy("grp"))
        bands = table.where(one & (F.col("segment") == banded) & (F.col("model") == model)).withColumn("falls", F.coalesce(F.col("bad_rate") <= before, F.lit(True)))
        out = out.unionByName(bands.groupBy("split", "segment").agg(F.bool_and("falls").alias("ok")).select(F.lit("bad rate falls with the band").alias("check"), "split", "segment", "ok"))
    if missing:
        gone = table.sparkSession.createDataFrame([(name,) for name in missing], "segment string")
        out = out.unionByName(gone.select(F.lit("columns are there").alias("check"), F.lit(None).cast("string").alias("split"), "segment", F.lit(False).alias("ok")))
    return out

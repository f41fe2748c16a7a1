"""Top-N per group (T1) and the text ranking report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def top_n(df: DataFrame, group, order: str, n: int = 5, ties=None,
          rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` rows with the largest ``order`` per ``group``.

    ``rank_col`` is zero-based (the first row is rank 0). Equal ``order``
    values are broken by ``ties`` ascending. A group with fewer than ``n``
    rows yields all of them.

    The filter is written as ``row_number() <= n`` so Spark plans a
    ``WindowGroupLimit``: each task keeps at most ``n`` rows per group before
    the shuffle, and only those are sorted afterwards.
    """
    group = _names(group)
    ties = _names(ties) if ties else []
    w = (Window.partitionBy(*group)
         .orderBy(F.col(order).desc(), *[F.col(t).asc() for t in ties]))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= n)
              .withColumn(rank_col, (F.col("_rn") - 1).cast("int"))
              .drop("_rn"))


# The report layout must equal the reference job's printed text.
REPORT_RULE = "===================================="
REPORT_TIME_LABEL = "时间: "
REPORT_KEY_LABEL = "  商品ID="
REPORT_COUNT_LABEL = "  浏览量="


def render_ranking(ranked: DataFrame, group: str, key: str, count: str,
                   rank_col: str = "rank", out_col: str = "report") -> DataFrame:
    """One text block per ``group`` value (a window end) from ranked rows.

    Layout (one line each): a rule, ``时间: <window end>``, then
    ``No<rank>:  商品ID=<key>  浏览量=<count>`` per ranked row in rank order,
    a rule, and an empty line. The time label prints the window end as
    ``yyyy-MM-dd HH:mm:ss.S``. The input must already be cut to the top rows,
    so each group gathers at most ``n`` entries.
    """
    entries = F.array_sort(F.collect_list(F.struct(
        F.col(rank_col).alias("r"), F.col(key).alias("k"), F.col(count).alias("c"))))
    body = F.array_join(F.transform(entries, _line), "")
    return (ranked.groupBy(group)
                  .agg(F.concat(F.lit(REPORT_RULE + "\n" + REPORT_TIME_LABEL),
                                F.date_format(F.col(group), "yyyy-MM-dd HH:mm:ss.S"),
                                F.lit("\n"), body,
                                F.lit(REPORT_RULE + "\n\n")).alias(out_col)))


def _line(e):
    return F.concat(F.lit("No"), e["r"].cast("string"), F.lit(":"),
                    F.lit(REPORT_KEY_LABEL), e["k"].cast("string"),
                    F.lit(REPORT_COUNT_LABEL), e["c"].cast("string"), F.lit("\n"))

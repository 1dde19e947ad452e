"""Job-level entry points of the batch side: the ETL from stored documents to the silver
table, and the three analytics from silver to TSV results.

The ETL folds its row counts into the write itself with ``observe()``: the stored
documents are scanned once, and the counts before cleaning, after cleaning and after the
explode come back with the write.  Only the distinct counts (not allowed in observed
metrics) read the written silver again, which is smaller than the source and already
cleaned.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from marquee.functions.values import count_distinct_with_null
from marquee.operators.analytics import avg_by_group, bucket_histogram, topk_by_group
from marquee.operators.clean import clamp_values, explode_categories, keep_nonempty, project_typed
from marquee.operators.preview import preview_rows
from marquee.sinks.writers import write_jsonl, write_single_result
from marquee.schemas import SILVER
from marquee.sources.readers import read_silver

# Columns of the silver preview printed by the ETL.
PREVIEW_COLS = ("title", "year", "rating", "votes", "genre")


@dataclass
class EtlReport:
    path: str
    rows_in: int
    rows_valid: int
    rows_silver: int
    distinct_ids: int
    distinct_genres: int
    preview: list = field(default_factory=list)

    def counts(self) -> dict:
        return {k: getattr(self, k) for k in
                ("rows_in", "rows_valid", "rows_silver", "distinct_ids", "distinct_genres")}


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_silver(silver: DataFrame, path: str, fmt: str = "json") -> None:
    """JSONL (the pipeline's contract: NULL fields omitted) or a columnar copy (``parquet``),
    which lets each analytic read only its columns at volume."""
    if fmt == "json":
        write_jsonl(silver, path)
    else:
        silver.write.mode("overwrite").format(fmt).save(path)


def load_silver(spark: SparkSession, path: str, fmt: str = "json", lenient: bool = False) -> DataFrame:
    if fmt == "json":
        return read_silver(spark, path, lenient=lenient)
    return spark.read.schema(SILVER).format(fmt).load(path)


def run_etl(spark: SparkSession, stored: DataFrame, out_path: str, preview_n: int = 5,
            fmt: str = "json", preview_order: Sequence[str] | None = ("movie_id", "genre")) -> EtlReport:
    """Stored documents → cleaned → one row per (item, genre) → silver at ``out_path``
    (overwrite; JSONL by default), with counts and a preview: the first rows by
    ``preview_order`` (a full scan of the silver), or with ``None`` any ``preview_n`` rows,
    which reads only as much of the silver as the limit needs."""
    docs, o_in = _observed(stored, "etl_rows_in")
    clean, o_valid = _observed(keep_nonempty(clamp_values(project_typed(docs))), "etl_rows_valid")
    silver, o_silver = _observed(explode_categories(clean), "etl_rows_silver")
    write_silver(silver, out_path, fmt)
    written = load_silver(spark, out_path, fmt)
    distinct = written.agg(count_distinct_with_null("movie_id").alias("ids"),
                           count_distinct_with_null("genre").alias("genres"))
    first_rows = (preview_rows(written, list(PREVIEW_COLS), list(preview_order), preview_n) if preview_order
                  else written.select(*PREVIEW_COLS).limit(preview_n))
    with ThreadPoolExecutor(max_workers=2) as pool:  # two independent reads of the silver
        d_f, p_f = pool.submit(distinct.first), pool.submit(first_rows.collect)
        d, preview = d_f.result(), p_f.result()
    return EtlReport(out_path, int(o_in.get["rows"]), int(o_valid.get["rows"]), int(o_silver.get["rows"]),
                     int(d["ids"]), int(d["genres"]), [r.asDict() for r in preview])


def etl_report_frame(spark: SparkSession, report: EtlReport) -> DataFrame:
    """The report's five counts as a one-row DataFrame."""
    schema = StructType([StructField(k, LongType()) for k in report.counts()])
    return spark.createDataFrame([tuple(report.counts().values())], schema)


# Layouts of the three TSV results (headerless).
AVG_TSV = StructType([StructField("genre", StringType()), StructField("avg_rating", StringType()),
                      StructField("n", LongType())])
TOP_TSV = StructType([StructField("year", IntegerType()), StructField("rank", IntegerType()),
                      StructField("title", StringType()), StructField("votes", IntegerType()),
                      StructField("rating", StringType())])
HIST_TSV = StructType([StructField("bucket", StringType()), StructField("n", LongType()),
                       StructField("pct", StringType())])
RESULT_LAYOUTS = {"avg_rating_by_genre": AVG_TSV, "top10_by_year": TOP_TSV, "rating_buckets": HIST_TSV}


def run_analytics(spark: SparkSession, silver_path: str, out_root: str, lenient: bool = False,
                  min_count: int = 50, k: int = 10, fmt: str = "json") -> dict[str, str]:
    """The three analytics over the silver table, each written as one ordered TSV file
    under ``out_root``; returns result name → folder."""
    silver = load_silver(spark, silver_path, fmt, lenient=lenient)
    results = {
        "avg_rating_by_genre": avg_by_group(silver, "genre", "rating", min_count=min_count, exact_scale=1),
        "top10_by_year": topk_by_group(silver, k=k),
        "rating_buckets": bucket_histogram(silver, "rating"),
    }
    paths = {name: f"{out_root.rstrip('/')}/{name}" for name in results}
    # Three independent jobs: submitted together, the scheduler runs their stages side by
    # side instead of leaving the cluster idle behind each one's final, narrow stage.
    with ThreadPoolExecutor(max_workers=len(results)) as pool:
        for f in [pool.submit(write_single_result, df, paths[name]) for name, df in results.items()]:
            f.result()
    return paths


def read_result(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(RESULT_LAYOUTS[name]).option("sep", "\t").csv(path)

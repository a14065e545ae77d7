"""Sources and sinks: JSON, JSON lines, YAML items, Markdown probes, vectors, manifests, judgments, reports."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinworks.functions.scalars import text_key

#: The data's major version that this package reads.
SCHEMA_MAJOR = 1
DATA_SETTING = "spark.skeinworks.data"


def data_dir(spark: SparkSession, default: str | None = None) -> str | None:
    """The root of the data: the session's setting, else the environment's, else the given one."""
    return spark.conf.get(DATA_SETTING, None) or os.environ.get("SKEINWORKS_DATA") or default


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads (globs allowed)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file that holds one JSON array or object."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; blank lines are skipped, a missing file is an empty table."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_json(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as plain text and sets as sorted arrays, so that JSON keeps them exactly and in one order."""
    out = df
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            out = out.withColumn(name, F.col(name).cast("string"))
        elif kind.startswith("array<") and "struct" not in kind and "map" not in kind:
            out = out.withColumn(name, F.array_sort(F.array_distinct(name)))
    return out


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    portable(df).write.mode(mode).json(path)


def write_split(df: DataFrame, path: str, column: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(column).json(path)


def read_books(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Observation files of all books, with the book's folder as ``book_id``."""
    rows = read_json(spark, path, schema)
    return rows.withColumn("book_id", F.element_at(F.split(F.input_file_name(), "/"), -2))


def read_yaml_items(spark: SparkSession, path: str, key: str = "items") -> DataFrame:
    """A YAML list of flat items, parsed on the driver: such files are written by hand. Values are text.

    The subset read: ``- name: value`` items with further ``name: value`` lines, optionally below ``key:``.
    """
    lines = [r.value for r in spark.read.option("wholetext", False).text(path).collect()]
    items: list[dict[str, str]] = []
    for line in lines:
        text = line.split(" #")[0].rstrip()
        body = text.strip()
        if not body or body.startswith("#") or body == f"{key}:":
            continue
        if body.startswith("- "):
            items.append({})
            body = body[2:]
        if items and ":" in body:
            name, _, value = body.partition(":")
            items[-1][name.strip()] = value.strip().strip("'\"")
    names = sorted({n for i in items for n in i})
    return spark.createDataFrame([tuple(i.get(n) for n in names) for i in items], T.StructType([T.StructField(n, T.StringType()) for n in names or ["item"]]))


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Markdown table of probes: ``probe_id, kind, query``."""
    row = r"^\|\s*([A-Za-z]*\d+)\s*\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|"
    lines = spark.read.text(path).where(F.col("value").rlike(row))
    return lines.select(*(F.regexp_extract("value", row, i).alias(n) for i, n in ((1, "probe_id"), (2, "kind"), (3, "query"))))


def embedded(texts: DataFrame, cached: DataFrame, model: str, fetch: Callable[[list[str]], list[list[float]]], batch: int = 10) -> DataFrame:
    """``text_hash, vec`` of each distinct text: from the cache by key, else fetched in batches; vectors have length 1.

    ``fetch`` is called only for texts that the cache lacks; ``cached``: ``text_hash, vec``.
    """
    from skeinworks.operators.retrieval import normalised

    keyed = texts.select("text").where("text IS NOT NULL").distinct().withColumn("text_hash", text_key(model, F.col("text")))
    hits = keyed.join(cached, "text_hash").select("text_hash", "vec")
    misses = keyed.join(cached.select("text_hash"), "text_hash", "left_anti")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                yield pd.DataFrame({"text_hash": part["text_hash"], "vec": fetch(part["text"].tolist())})

    new = misses.select("text", "text_hash").mapInPandas(run, "text_hash string, vec array<float>")
    return hits.unionByName(new).withColumn("vec", normalised(F.col("vec")).cast("array<float>"))


# ---- manifest


def file_entries(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, sha256`` of the files of a folder; line ends of text count as one character."""
    rows = spark.read.format("binaryFile").load(path)
    text = F.regexp_replace(F.decode("content", "ISO-8859-1"), "\r\n", "\n")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.length(text).cast("long").alias("bytes"), F.sha2(F.encode(text, "ISO-8859-1"), 256).alias("sha256"))


def verify_manifest(listed: DataFrame, actual: DataFrame) -> DataFrame:
    """Files that are ``unlisted``, ``missing`` or ``differ``: a full outer join by name."""
    a = listed.select("file", F.col("sha256").alias("_a"))
    b = actual.select("file", F.col("sha256").alias("_b"))
    problem = F.when(F.col("_a").isNull(), "unlisted").when(F.col("_b").isNull(), "missing").when(F.col("_a") != F.col("_b"), "differs")
    return a.join(b, "file", "full").select("file", problem.alias("problem")).where("problem IS NOT NULL")


def check_compatible(version: str) -> None:
    if int(str(version).split(".")[0]) != SCHEMA_MAJOR:
        raise ValueError(f"data of version {version}; this package reads {SCHEMA_MAJOR}.x")


# ---- judgments


def request_key(model: str, mode: str, messages, extra: str = ""):
    """Key of a cached answer: SHA-256 of all that determines it."""
    return F.sha2(F.concat_ws("\n", F.lit(model), F.lit(mode), messages, F.lit(extra)), 256)


def with_cached_answers(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests with their cached answer, requests without one). Answers come from outside; the engine never calls a model."""
    joined = requests.join(cache.select("request_key", "answer"), "request_key", "left")
    return joined.where("answer IS NOT NULL"), joined.where("answer IS NULL").drop("answer")


def answer_costs(answers: DataFrame, input_price: float, output_price: float) -> DataFrame:
    """Cost by model of ``model, input_tokens, output_tokens``, prices by a million tokens."""
    cost = (F.col("input_tokens") * input_price + F.col("output_tokens") * output_price) / 1e6
    return answers.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(cost), 7).alias("cost"))


# ---- reports


def _small(df: DataFrame, order: list[str], most: int) -> list:
    """All rows in order; ValueError if there are more than ``most``, for nothing is left out."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: aggregate them, or write them with DataFrame.write")
    return rows


def markdown_table(df: DataFrame, order: list[str], most: int = 1000) -> str:
    """A small aggregate as a Markdown table, rendered on the driver; ValueError if it has more than ``most`` rows."""
    rows = _small(df, order, most)
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return "\n".join([head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)])


def write_report(path: str, sections: dict[str, str]) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n\n".join(f"## {title}\n\n{body}" for title, body in sections.items()) + "\n")


def json_payload(df: DataFrame, order: list[str], most: int = 100_000) -> str:
    """A small aggregate as one deterministic JSON array; ValueError if it has more than ``most`` rows."""
    return json.dumps([r.asDict(recursive=True) for r in _small(df, order, most)], ensure_ascii=False, sort_keys=True, default=str)

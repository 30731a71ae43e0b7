"""JSON responses landed as files, or JSON text columns -> key/value rows.

``read_json_documents`` infers no types and drops nothing: a document is parsed to a variant,
its nested fields become (path, value) rows, and text that is no JSON is kept apart as it came.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import stage


def read_landed_json(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """The documents' top-level fields as columns, their types inferred by Spark's JSON reader."""
    return spark.read.option("multiLine", multi_line).json(path)


def read_json_documents(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """One row per document: file, row_no (order within the file's split), text, document
    (variant, NULL where the text is no JSON). A file is one document with ``multi_line``,
    else every non-empty line is. Folders like ``k=1/`` add the column k."""
    text = spark.read.text(path, wholetext=multi_line)
    keep = [c for c in text.columns if c != "value"]
    rows = text.select(*[F.col(f"`{c}`") for c in keep], F.col("_metadata.file_path").alias("file"),
                       F.monotonically_increasing_id().alias("row_no"), F.col("value").alias("text"))
    rows = rows.where(F.length(F.trim("text")) > 0)
    return rows.select("*", F.try_parse_json("text").alias("document"))


def malformed_json(landed: DataFrame, text: str = "text", document: str = "document") -> DataFrame:
    """The quarantine: rows whose text is no JSON, as they landed."""
    return landed.where(F.col(document).isNull() & F.col(text).isNotNull()).drop(document)


def flatten_json(df: DataFrame, document: str, keep: Sequence[str] = (), path: str = "path", value: str = "value",
                 max_depth: int = 64) -> DataFrame:
    """A variant's leaves as rows: ``keep`` columns, path ($.a.b[2]), value as text (NULL for
    JSON null). Empty objects and arrays are leaves with their JSON text; a NULL document has none.

    Each round opens one level of nesting of what is still nested, so the rounds are the depth
    of the deepest document, not their number. Deeper than ``max_depth`` raises."""
    columns = [f"`{k}`" for k in keep]
    todo = df.select(*[F.col(c) for c in columns], F.lit("$").alias("__p"), F.col(document).alias("__v")).where(F.col("__v").isNotNull())
    leaves = None
    for _ in range(max_depth):
        kind = F.schema_of_variant("__v")
        text = F.col("__v").cast("string")
        nested = (kind.startswith("OBJECT") | kind.startswith("ARRAY")) & ~text.isin("{}", "[]")
        todo = stage(todo.select("*", nested.alias("__nested"), kind.startswith("ARRAY").alias("__array")), "json_level")
        done = todo.where(~F.col("__nested")).select(*columns, F.col("__p").alias(path), F.col("__v").cast("string").alias(value))
        leaves = done if leaves is None else leaves.unionByName(done)
        if todo.where("__nested").isEmpty():
            return leaves
        step = "CASE WHEN __array THEN concat(__p, '[', e.pos, ']') ELSE concat(__p, '.', e.key) END"
        todo = df.sparkSession.sql(f"SELECT {''.join(c + ', ' for c in columns)}{step} AS __p, e.value AS __v "
                                   "FROM {level}, LATERAL variant_explode(__v) e", level=todo.where("__nested"))
    raise ValueError(f"documents are nested deeper than {max_depth} levels")


def json_key_values(df: DataFrame, json_col: str, keep: Sequence[str] = (),
                    key: str = "key", value: str = "value") -> DataFrame:
    """Top-level fields of a JSON object column -> one (key, value-as-text) row each."""
    m = F.from_json(F.col(f"`{json_col}`"), "map<string,string>")
    return (df.select(*[F.col(f"`{k}`") for k in keep], F.explode_outer(m).alias(key, value))
            .where(F.col(key).isNotNull()))

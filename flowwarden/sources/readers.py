"""Batch reads: CSV, Parquet and JSON sidecars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.operators.ranking import last_write


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Inference costs a second pass over the files, so a schema is preferred."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_flow_files(
    spark: SparkSession,
    folder: str,
    patterns: list[str],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All CSV files of the first pattern that matches any file in the folder or below it."""
    for pattern in patterns:
        if _has_files(spark, folder, pattern):
            reader = spark.read.option("header", True).option("pathGlobFilter", pattern)
            reader = reader.option("recursiveFileLookup", True)
            return reader.schema(schema).csv(folder) if schema else reader.option("inferSchema", True).csv(folder)
    raise FileNotFoundError(f"no files matching {patterns} in {folder}")


def _has_files(spark: SparkSession, folder: str, pattern: str) -> bool:
    names = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return not names.select("path").limit(1).isEmpty()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_feature_list(spark: SparkSession, path: str) -> DataFrame:
    """Feature names in order from a sidecar that holds ``{"features": [...]}``."""
    doc = spark.read.schema("features array<string>").json(path, multiLine=True)
    return doc.select(F.posexplode("features").alias("position", "feature"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """Id and name from a sidecar; ids that are no integers are skipped.

    Three layouts are read: ``{"reverse_mapping": {id: name}}``, ``{"attack_mapping": {name: id}}`` and
    plain ``{id: name}``; the first that the document has counts. Where two names share an id in the
    name-to-id layout, the later one counts.
    """
    text = spark.read.text(path, wholetext=True).select("value")
    named = {
        layout: F.from_json(F.get_json_object("value", f"$.{layout}"), "map<string,string>")
        for layout in ("reverse_mapping", "attack_mapping")
    }
    swapped = F.transform(
        F.map_entries(named["attack_mapping"]),
        lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")),
    )
    plain = F.map_entries(F.from_json("value", "map<string,string>"))
    entries = text.select(
        F.posexplode(F.coalesce(F.map_entries(named["reverse_mapping"]), swapped, plain)).alias("position", "entry")
    )
    rows = entries.select(
        F.col("entry.key").try_cast("int").alias("attack_cat_id"),
        F.col("entry.value").alias("attack_type"),
        "position",
    )
    return last_write(rows.where(F.col("attack_cat_id").isNotNull()), ["attack_cat_id"], ["position"]).drop("position")


def write_label_map(spark: SparkSession, path: str, ids: Mapping[str, int], layout: str = "both") -> None:
    """A label map as one JSON document: ``both`` directions under their names, or ``plain``."""
    forward = F.create_map(*[x for n, i in ids.items() for x in (F.lit(n), F.lit(str(i)))])
    backward = {str(i): n for n, i in ids.items()}
    one = spark.range(1).coalesce(1)
    if layout == "plain":
        columns = [F.lit(n).alias(i) for i, n in backward.items()]
    else:
        reverse = F.create_map(*[x for i, n in backward.items() for x in (F.lit(i), F.lit(n))])
        columns = [forward.alias("attack_mapping"), reverse.alias("reverse_mapping")]
    one.select(*columns).write.json(path)


def write_feature_list(spark: SparkSession, path: str, features: list[str]) -> None:
    """Feature names in order, as ``{"features": [...]}``."""
    spark.range(1).coalesce(1).select(F.array(*[F.lit(f) for f in features]).alias("features")).write.json(path)


def write_results(spark: SparkSession, path: str, results: Mapping[str, tuple[dict, dict]]) -> None:
    """One line per model: its name, parameters and metrics."""
    rows = [
        (name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})
        for name, (params, metrics) in results.items()
    ]
    schema = "model string, params map<string,string>, metrics map<string,double>"
    spark.createDataFrame(rows, schema).coalesce(1).write.json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("model string, params map<string,string>, metrics map<string,double>").json(path)

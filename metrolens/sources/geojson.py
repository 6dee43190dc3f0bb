"""GeoJSON FeatureCollections as distributed DataFrames.

Three layouts are read:

* ``"document"``: each file is one FeatureCollection (pretty or single-line).
  The JSON reader parses it with ``multiLine`` and ``inline(features)`` turns
  the array into rows, one task a file. Files of more than ``WHOLE`` bytes are
  cut at bytes across tasks as in the ``"split"`` layout, by this layout's rules;
  properties read as a string are then without the file's white space, as in the
  other layouts.
* ``"lines"``: one feature per line, between a header and a footer line. Lines
  are read as text, trailing commas removed and parsed with ``from_json``; the
  files split freely across tasks. A line holding a whole single-line
  FeatureCollection is expanded too.
* ``"split"``: a large FeatureCollection document of any line layout, also all on
  one line, cut at bytes across many tasks (see :mod:`metrolens.sources.json_split`).

A file that is cut off, or is not in the stated layout, fails the query: no
layout returns part of a document. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from metrolens.sources.json_split import member_elements

LAYOUTS = ("document", "lines", "split")
WHOLE = 4 << 20  # bytes of a document that one task parses; a compressed one cannot be cut
_COMPRESSED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|xz)$"


def _feature_type(properties_type: str) -> str:
    return f"struct<type:string, geometry:struct<type:string>, properties:{properties_type}>"


def _fail(message: str, kind: DataType | str = "boolean") -> Column:
    # The UUID makes it non-deterministic: the optimizer then neither moves later
    # filters below the check nor the check below filters that it relies on.
    return F.raise_error(F.concat(F.lit(message + ", check "), F.uuid())).cast(kind)


def _holds(condition: Column, message: str) -> Column:
    """True where ``condition`` holds; anywhere else the query fails."""
    return F.when(condition, F.lit(True)).otherwise(_fail(message))


def _features_from_document(spark: SparkSession, paths: Sequence[str], properties_type: str) -> DataFrame:
    # Names and sizes only: the content is not selected.
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    cut = (F.col("length") > WHOLE) & ~F.col("path").rlike(_COMPRESSED)
    large = [r.path for r in files.filter(cut).collect()]
    if not large:
        return _features_from_whole_documents(spark, paths, properties_type)
    texts = member_elements(spark, large, "features", _holds, "FeatureCollection")
    parsed = F.from_json("text", _feature_type(properties_type), {"mode": "FAILFAST"})
    features = texts.select(F.when(F.col("text") != "null", parsed).alias("f")).select("f.type", "f.geometry", "f.properties")
    small = [r.path for r in files.filter(~cut).collect()]
    return features.unionByName(_features_from_whole_documents(spark, small, properties_type)) if small else features


def _features_from_whole_documents(spark: SparkSession, paths: Sequence[str], properties_type: str) -> DataFrame:
    schema = f"type string, features array<{_feature_type(properties_type)}>"
    docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(list(paths))
    whole = (F.col("type") == "FeatureCollection") & F.col("features").isNotNull()
    return docs.filter(_holds(F.coalesce(whole, F.lit(False)), "not a FeatureCollection document")).selectExpr(
        "inline(features)"
    )


# First and last line of the "lines" layout.
_HEADER = r'^\{(?=.*"type"\s*:\s*"FeatureCollection").*"features"\s*:\s*\[$'
_FOOTER = r"^\](?:\s*,.*)?\}$"


def _features_from_lines(lines: DataFrame, properties_type: str, file: Column | None = None) -> DataFrame:
    """Features of lines of text; ``file`` names the file of each, whose header
    and footer must then match."""
    value = F.expr("trim(BOTH ',' FROM trim(value))")
    schema = (
        f"struct<type:string, geometry:struct<type:string>, properties:{properties_type}, "
        f"features:array<{_feature_type(properties_type)}>, broken:string>"
    )
    named = lines.select(value.alias("v"), (F.lit("") if file is None else file).alias("file"))
    # Only a line with the right first and last character is held against a pattern.
    header = F.col("v").startswith("{") & F.col("v").endswith("[") & F.col("v").rlike(_HEADER)
    footer = F.col("v").startswith("]") & F.col("v").rlike(_FOOTER)
    told = named.filter(F.col("v") != "").select("v", "file", header.alias("header"), footer.alias("footer"))
    parsed = told.filter(~F.col("header") & ~F.col("footer")).select(
        F.from_json("v", schema, {"columnNameOfCorruptRecord": "broken"}).alias("j")
    )
    one = F.struct(
        F.col("j.type").alias("type"), F.col("j.geometry").alias("geometry"), F.col("j.properties").alias("properties")
    )
    whole = F.col("j.broken").isNull()
    features = (
        F.when(whole & (F.col("j.type") == "Feature"), F.array(one))
        .when(whole & (F.col("j.type") == "FeatureCollection") & F.col("j.features").isNotNull(), F.col("j.features"))
        .otherwise(_fail("a line is neither a feature nor a collection", f"array<{_feature_type(properties_type)}>"))
    )
    found = parsed.select(F.explode(features).alias("f")).select("f.*")
    if file is None:
        return found
    # A cut-off file misses its footer. This branch yields no rows; it fails or is empty.
    ends = (
        told.filter("header OR footer")
        .groupBy("file")
        .agg(F.count_if("header").alias("opened"), F.count_if("footer").alias("closed"))
        .filter(~_holds(F.col("opened") == F.col("closed"), "a collection is not closed"))
    )
    # Not a constant null: filters over that would remove the branch with its check.
    null = F.when(F.col("opened") < 0, F.col("file"))
    nothing = [
        (null if f.dataType.typeName() == "string" else F.from_json(null, f.dataType)).alias(f.name)
        for f in found.schema.fields
    ]
    return found.unionByName(ends.select(*nothing))


def read_features(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties_type: str,
    layout: str = "document",
) -> DataFrame:
    """Rows (type, geometry, properties) for every feature in the files."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if layout == "document":
        return _features_from_document(spark, paths, properties_type)
    if layout == "split":
        return _features_from_split_text(spark, paths, properties_type)
    return _features_from_lines(spark.read.text(paths), properties_type, F.col("_metadata.file_path"))


def _features_from_split_text(spark: SparkSession, paths: Sequence[str], properties_type: str) -> DataFrame:
    """Features of FeatureCollection documents of any line layout, split across tasks."""
    texts = member_elements(spark, paths, "features", _holds)
    schema = f"struct<type:string, geometry:struct<type:string>, properties:{properties_type}, broken:string>"
    parsed = texts.select(F.from_json("text", schema, {"columnNameOfCorruptRecord": "broken"}).alias("f"))
    sound = F.coalesce(F.col("f.broken").isNull() & (F.col("f.type") == "Feature"), F.lit(False))
    checked = F.when(sound, F.col("f")).otherwise(_fail("a member of features is no feature", parsed.schema["f"].dataType))
    return parsed.select(checked.alias("f")).select("f.type", "f.geometry", "f.properties")


def parse_geojson(df: DataFrame, column: str, props: Sequence[str]) -> DataFrame:
    """Features from a string column holding FeatureCollection documents or single features;
    the properties come as text."""
    fields = ", ".join(f"`{p}`:string" for p in props)
    return _features_from_lines(df.select(F.col(column).alias("value")), f"struct<{fields}>")


def to_int(c: Column) -> Column:
    """Integer from number text: '12' -> 12, '5.7' -> 5 (truncated, as int() of a float), bad -> NULL."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def truthy(value: Column) -> Column:
    """Whether a VARIANT value counts as given: not missing, null, false, a zero or empty."""
    kind = F.schema_of_variant(value)
    text = value.try_cast("string")
    empty = (
        F.when(kind == "VOID", F.lit(True))
        .when(kind == "STRING", text == "")
        .when(kind == "BOOLEAN", text == "false")
        .when(kind.rlike("^(ARRAY|OBJECT)<"), F.to_json(value).isin("[]", "{}"))
        .otherwise(text.try_cast("double") == 0.0)
    )
    return value.isNotNull() & ~F.coalesce(empty, F.lit(False))


def feature_points(
    features: DataFrame,
    key_prop: str,
    value_prop: str,
    key_name: str = "zipcode",
    value_name: str = "population",
) -> DataFrame:
    """(key, value) per feature whose key and value are both truthy as JSON values.

    ``features`` has the properties as raw JSON text: a number 0 is dropped, the
    text "0" is not, and 0.5 is kept as 0, like any number truncated."""
    given = features.select(F.try_parse_json("properties").alias("p"))
    key = F.try_variant_get("p", f"$[{_quoted(key_prop)}]", "variant")
    value = F.try_variant_get("p", f"$[{_quoted(value_prop)}]", "variant")
    both = given.select(key.alias("k"), value.alias("v")).filter(truthy(F.col("k")) & truthy(F.col("v")))
    number = F.when(F.col("v").try_cast("string") == "true", F.lit(1)).otherwise(to_int(F.col("v").try_cast("string")))
    return both.select(F.col("k").try_cast("string").alias(key_name), number.alias(value_name)).filter(
        F.col(key_name).isNotNull() & F.col(value_name).isNotNull()
    )


def _quoted(name: str) -> str:
    if "'" in name or "\\" in name:
        raise ValueError(f"a property name without quotes and backslashes is expected, not {name!r}")
    return f"'{name}'"


def read_geojson(
    spark: SparkSession,
    paths: str | Sequence[str],
    key_prop: str = "ZCTA20",
    value_prop: str = "POP20",
    layout: str = "document",
    key_name: str = "zipcode",
    value_name: str = "population",
) -> DataFrame:
    """(zipcode, population) rows of a census-block FeatureCollection."""
    # A STRING field receives the raw JSON text of the properties object.
    features = read_features(spark, paths, "string", layout)
    return feature_points(features, key_prop, value_prop, key_name, value_name)


def profile_geojson(spark: SparkSession, paths: str | Sequence[str], layout: str = "document") -> DataFrame:
    """Structure of a FeatureCollection over *all* features (not just the first):
    rows (kind, name, value_type, features) for feature types, geometry types,
    and every property key with the VARIANT type of its values."""
    # A STRING field receives the raw JSON text of the properties object.
    features = read_features(spark, paths, "string", layout)
    kinds = features.select(
        F.explode(
            F.array(
                F.struct(F.lit("feature_type").alias("kind"), F.col("type").alias("name")),
                F.struct(F.lit("geometry_type").alias("kind"), F.col("geometry.type").alias("name")),
            )
        ).alias("k")
    ).groupBy("k.kind", "k.name").agg(F.count(F.lit(1)).alias("features"))
    kinds = kinds.select("kind", "name", F.lit(None).cast("string").alias("value_type"), "features")
    props = spark.sql(
        """
        SELECT 'property' AS kind, e.key AS name, schema_of_variant(e.value) AS value_type, COUNT(*) AS features
        FROM (SELECT try_parse_json(properties) AS p FROM {features}) t,
             LATERAL variant_explode(t.p) e
        GROUP BY e.key, schema_of_variant(e.value)
        """,
        features=features,
    )
    return kinds.unionByName(props)


def write_geojson(df: DataFrame, path: str, layout: str = "lines") -> str:
    """Write rows as GeoJSON polygons without coordinates whose properties are
    the columns of ``df`` (NULL properties are written as null).

    Every output file (one per partition) is one FeatureCollection, so readers
    of either layout split the work by file. ``layout="lines"`` writes one
    feature per line, ``"pretty"`` indents, ``"oneline"`` puts the whole file on one line. The features are rendered by
    ``to_json``; a small streaming pass only adds header, commas and footer.
    """
    if layout not in ("lines", "pretty", "oneline"):
        raise ValueError("layout must be 'lines', 'pretty' or 'oneline'")
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array().cast("array<string>").alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        geometry.alias("geometry"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("properties"),
    )
    options = {"ignoreNullFields": "false", "pretty": str(layout == "pretty").lower()}
    rendered = df.select(F.to_json(feature, options).alias("value"))

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ['{"type": "FeatureCollection", "features": [']})
        held = None
        for batch in batches:
            texts = ([held] if held is not None else []) + batch["value"].tolist()
            held = texts.pop() if texts else None
            if texts:
                yield pd.DataFrame({"value": [t + "," for t in texts]})
        yield pd.DataFrame({"value": ([held] if held is not None else []) + ["]}"]})

    separator = " " if layout == "oneline" else "\n"
    rendered.mapInPandas(frame, "value string").write.mode("overwrite").option("lineSep", separator).text(path)
    return path

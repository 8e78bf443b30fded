"""JSON, struct and array operators (N1-N8) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog import register
from ledgerline.catalog.q_staging import PEOPLE_SCHEMA
from ledgerline.operators import nested
from ledgerline.session import table

_PROPS_TEXT = """CASE event_type WHEN 'error' THEN '{"k": oops' WHEN 'view' THEN '[]'
  WHEN 'signup' THEN '' ELSE props END"""

K_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@register("nested_parse_json", f"""
SELECT event_id, CAST(json_extract(t, '$.k') AS INTEGER) AS k
FROM (SELECT event_id, {_PROPS_TEXT} AS t FROM events)
WHERE t IS NOT NULL AND t NOT IN ('', '[]', '{{}}', 'null') AND json_valid(t)
  AND json_type(t) = 'OBJECT' AND json_extract(t, '$.k') IS NOT NULL""")
def nested_parse_json(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr(_PROPS_TEXT).alias("t"))
    parsed = nested.parse_json(e, "t", K_SCHEMA, "p")
    return parsed.select("event_id", F.col("p.k").alias("k"))


EVENT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField("value_cents", T.LongType()),
                                           T.StructField("k", T.IntegerType())])),
])


@register("nested_flatten_struct", """
SELECT event_id, event_type AS event__kind, CAST(round(value * 100) AS BIGINT) AS event__metrics__value_cents,
       CAST(json_extract(props, '$.k') AS INTEGER) AS event__metrics__k
FROM events""")
def nested_flatten_struct(spark, d):
    e = table(spark, d, "events")
    doc = F.to_json(F.struct(F.col("event_type").alias("kind"), F.struct(
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        F.get_json_object("props", "$.k").cast("int").alias("k")).alias("metrics")))
    parsed = nested.parse_json(e.select("event_id", doc.alias("event")), "event", EVENT_SCHEMA, "p")
    return nested.flatten_struct(parsed, "p", "event", ["event_id"])


def _people_docs(spark, d):
    """One JSON document per conversation turn (an array holding one person),
    so no conversation is gathered into a single row."""
    conv = table(spark, d, "conversations")
    return conv.select("conv_id", F.to_json(F.array(F.struct(
        F.col("role").alias("name"), F.split(F.col("text"), "\n").alias("titles")))).alias("associated_people"))


@register("nested_double_explode", """
SELECT conv_id, role AS associated_people__name, unnest(string_split(text, chr(10))) AS associated_people__titles
FROM conversations WHERE text IS NOT NULL""")
def nested_double_explode(spark, d):
    parsed = nested.parse_json(_people_docs(spark, d), "associated_people", PEOPLE_SCHEMA, "_p")
    return nested.explode_nested(parsed, "_p", "titles", "associated_people", ["conv_id"])


@register("nested_join_array", """
SELECT conv_id, string_agg(DISTINCT role, ';' ORDER BY role) AS roles FROM conversations GROUP BY conv_id""")
def nested_join_array(spark, d):
    conv = table(spark, d, "conversations")
    roles = conv.groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("r"))
    return nested.simple_array(roles, "r", "roles", ["conv_id"])


@register("nested_explode_structs", """
SELECT vec_id, idx, CAST(round(CAST(v AS DOUBLE), 4) AS DECIMAL(12,4)) AS val, label
FROM (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS idx FROM embeddings)""")
def nested_explode_structs(spark, d):
    e = table(spark, d, "embeddings")
    arr = F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("idx"), x.alias("v")))
    flat = nested.explode_structs(e.select("vec_id", "label", arr.alias("items")), "items", ["vec_id", "label"])
    return flat.select("vec_id", "idx", F.round(F.col("v").cast("double"), 4).cast("decimal(12,4)").alias("val"),
                       "label")


@register("nested_explode_values", """
SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL""")
def nested_explode_values(spark, d):
    doc = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return nested.explode_values(doc, "lines", ["doc_id"], out="line")


@register("nested_combine", """
WITH base AS (SELECT DISTINCT c_custkey FROM customer),
seg AS (SELECT c_custkey * 2 AS c_custkey, c_mktsegment AS segment FROM customer),
nat AS (SELECT c.c_custkey, n.n_name AS nation FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey + 2)
SELECT DISTINCT b.c_custkey, seg.segment, nat.nation FROM base b
LEFT JOIN seg ON b.c_custkey = seg.c_custkey LEFT JOIN nat ON b.c_custkey = nat.c_custkey
WHERE (seg.segment IS NOT NULL AND seg.segment NOT IN ('', '[]', '{}'))
   OR (nat.nation IS NOT NULL AND nat.nation NOT IN ('', '[]', '{}'))""")
def nested_combine(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    seg = c.select((F.col("c_custkey") * 2).alias("c_custkey"), F.col("c_mktsegment").alias("segment"))
    nat = c.join(n, c.c_nationkey == n.n_nationkey + 2) \
           .select("c_custkey", F.col("n_name").alias("nation"))
    return nested.combine(c, {"segment": seg, "nation": nat}, "c_custkey")


@register("nested_flatten_config", """
SELECT conv_id, turn, role || ';turn-' || CAST(turn AS VARCHAR) AS roles FROM conversations""")
def nested_flatten_config(spark, d):
    conv = table(spark, d, "conversations")
    docs = conv.select("conv_id", "turn", F.to_json(F.array(
        F.col("role"), F.concat(F.lit("turn-"), F.col("turn").cast("string")))).alias("roles_json"))
    frames = nested.flatten(docs, [nested.FlattenConfig("roles_json", T.ArrayType(T.StringType()),
                                                         "simple_array", "roles")], ["conv_id", "turn"])
    return frames["roles_json"]

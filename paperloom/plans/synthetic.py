"""Contracts and NDAs written from the star-schema tables, so that every expected fact is a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.model import no_bbox

STATES = ("Delaware", "New York", "California", "Texas", "West Virginia")


def parties(spark: SparkSession, sf_dir: str, tasks_of: int | None = None) -> DataFrame:
    """One row per order: doc_id, name, state, day, amount, days, renews. With ``tasks_of`` the orders are dealt first, about so many to a task."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if tasks_of:
        orders = orders.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-orders.count() // tasks_of)), "o_orderkey")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.select(
        F.col("o_orderkey").cast("string").alias("doc_id"), F.replace("c_name", F.lit("#"), F.lit("")).alias("name"),
        F.element_at(F.array(*[F.lit(s) for s in STATES]), (F.col("o_custkey") % 5 + 1).cast("int")).alias("state"), F.date_format("o_orderdate", "MMMM d, yyyy").alias("day"),
        F.floor("o_totalprice").alias("amount"), ((F.col("o_orderkey") % 4 + 1) * 15).alias("days"), (F.col("o_orderstatus") == "O").alias("renews"),
    )


def _items(parts: list) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(kind).alias("type"), text.alias("text"))) for kind, cond, text in parts]))


def _blocks(rows: DataFrame, parts: list) -> DataFrame:
    items = _items(parts)
    cut = rows.select("doc_id", F.posexplode(items).alias("pos", "b"))
    return cut.select(
        "doc_id", "pos", F.concat(F.lit("#/b/"), "pos").alias("block_id"), "b.type", "b.text", no_bbox().alias("bbox"), F.lit(None).cast("string").alias("parent_id"),
        F.lit(1.0).alias("confidence"), F.lit("docling").alias("source_engine"),
    )


def contracts(rows: DataFrame) -> DataFrame:
    return _blocks(rows, _contract_parts())


def whole_contracts(rows: DataFrame) -> DataFrame:
    """The rows with the blocks of their contract in ``blocks``, see ``operators.whole``."""
    return rows.withColumn("blocks", F.transform(_items(_contract_parts()), lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text"), F.lit(None).cast("int").alias("page"), F.lit(1.0).alias("confidence"))))


def _contract_parts() -> list:
    yes, c = F.lit(True), F.concat
    return [
        ("title", yes, F.lit("Master Services Agreement")),
        ("paragraph", yes, c(F.lit("This Agreement is entered into by and between "), "name", F.lit(" Inc. and Vendor Holdings LLC, effective as of "), "day", F.lit("."))),
        ("heading", yes, F.lit("Governing Law")),
        ("paragraph", yes, c(F.lit("This Agreement shall be governed by the laws of the State of "), "state", F.lit("."))),
        ("heading", yes, F.lit("Terms")),
        ("paragraph", yes, c(F.lit("The total fees payable are $"), F.col("amount").cast("string"), F.lit("."))),
        ("paragraph", yes, c(F.lit("Either party may terminate this Agreement on "), F.col("days").cast("string"), F.lit(" days written notice."))),
        ("paragraph", F.col("renews"), F.lit("This Agreement shall automatically renew for successive one year terms.")),
        ("heading", yes, F.lit("Services")),
        ("paragraph", yes, F.lit('"Services" means the work described in Exhibit A. The Services are provided by Vendor Holdings LLC.')),
        ("paragraph", yes, c(F.lit("All Confidential Information of "), "name", F.lit(" is proprietary and the Services may use it."))),
    ]


def ndas(rows: DataFrame) -> DataFrame:
    yes, c = F.lit(True), F.concat
    return _blocks(rows, [
        ("title", yes, F.lit("MUTUAL NON-DISCLOSURE AGREEMENT")),
        ("paragraph", yes, c(F.lit("This Non-Disclosure Agreement is entered into by and between "), "name", F.lit(' Inc. ("Disclosing Party") and Vendor Holdings LLC ("Receiving Party").'))),
        ("paragraph", yes, c(F.lit("This Agreement is effective as of "), "day", F.lit("."))),
        ("paragraph", yes, F.lit("This Agreement shall remain in full force and effect for two (2) years from the Effective Date.")),
        ("paragraph", F.col("renews"), F.lit("The obligations of confidentiality shall survive for five (5) years following any termination of this Agreement.")),
        ("paragraph", yes, F.lit("The Receiving Party shall return or destroy all materials.")),
        ("paragraph", yes, c(F.lit("This Agreement shall be governed by the laws of the State of "), "state", F.lit("."))),
    ])


def contract_gold(rows: DataFrame) -> DataFrame:
    """Labels as an annotator would write them; every seventh order's state is labelled wrongly on purpose."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in contract_labels()])
    return rows.select("doc_id", F.explode(pairs).alias("p")).select("doc_id", "p.field", "p.value")


def contract_labels() -> list[tuple[str, Column]]:
    return [
        ("counterparty", F.concat("name", F.lit(" Inc."))),
        ("effective_date", F.col("day")),
        ("governing_law", F.when(F.col("doc_id").cast("long") % 7 == 0, "Ohio").otherwise(F.col("state"))),
        ("total_value", F.concat(F.lit("$"), F.col("amount").cast("string"), F.lit(".00"))),
        ("termination_notice_days", F.concat(F.col("days").cast("string"), F.lit(" days"))),
        ("auto_renewal", F.when(F.col("renews"), "yes").otherwise("")),
    ]


#: The same rows in DuckDB.
PARTIES_SQL = """
p AS (
  SELECT o_orderkey::VARCHAR AS doc_id, replace(c_name, '#', '') AS name, ['Delaware', 'New York', 'California', 'Texas', 'West Virginia'][(o_custkey % 5 + 1)::INT] AS state,
         strftime(o_orderdate, '%B %-d, %Y') AS day, floor(o_totalprice)::BIGINT AS amount, (o_orderkey % 4 + 1) * 15 AS days, o_orderstatus = 'O' AS renews
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""
CONTRACT_BLOCKS_SQL = """
cb0 AS (
  SELECT doc_id, unnest(list_filter([
    {'type': 'title', 'text': 'Master Services Agreement'},
    {'type': 'paragraph', 'text': 'This Agreement is entered into by and between ' || name || ' Inc. and Vendor Holdings LLC, effective as of ' || day || '.'},
    {'type': 'heading', 'text': 'Governing Law'},
    {'type': 'paragraph', 'text': 'This Agreement shall be governed by the laws of the State of ' || state || '.'},
    {'type': 'heading', 'text': 'Terms'},
    {'type': 'paragraph', 'text': 'The total fees payable are $' || amount || '.'},
    {'type': 'paragraph', 'text': 'Either party may terminate this Agreement on ' || days || ' days written notice.'},
    CASE WHEN renews THEN {'type': 'paragraph', 'text': 'This Agreement shall automatically renew for successive one year terms.'} END,
    {'type': 'heading', 'text': 'Services'},
    {'type': 'paragraph', 'text': '"Services" means the work described in Exhibit A. The Services are provided by Vendor Holdings LLC.'},
    {'type': 'paragraph', 'text': 'All Confidential Information of ' || name || ' is proprietary and the Services may use it.'}
  ], lambda b: b IS NOT NULL)) AS b, generate_subscripts(list_filter([1,2,3,4,5,6,7,CASE WHEN renews THEN 8 END,9,10,11], lambda b: b IS NOT NULL), 1) - 1 AS pos
  FROM p
), cb AS (SELECT doc_id, pos::INT AS pos, '#/b/' || pos AS block_id, b.type AS type, b.text AS text FROM cb0)"""
FACTS_SQL = """
f AS (
  SELECT doc_id, 'counterparty' AS field, name || ' Inc; Vendor Holdings LLC' AS value, '#/b/1' AS source_block_id, 0.7::DOUBLE AS confidence FROM p
  UNION ALL SELECT doc_id, 'effective_date', day, '#/b/1', 0.65 FROM p
  UNION ALL SELECT doc_id, 'governing_law', state, '#/b/3', 0.7 FROM p
  UNION ALL SELECT doc_id, 'total_value', '$' || amount, '#/b/5', 0.4 FROM p
  UNION ALL SELECT doc_id, 'termination_notice_days', 'on ' || days || ' days', '#/b/6', 0.55 FROM p
  UNION ALL SELECT doc_id, 'auto_renewal', CASE WHEN renews THEN 'yes' ELSE '' END, CASE WHEN renews THEN '#/b/7' END, CASE WHEN renews THEN 0.55 ELSE 0 END FROM p
)"""

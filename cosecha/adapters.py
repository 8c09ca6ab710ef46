"""Adapter views: the driver's TPC-H-like tables reshaped into the input
contracts the flows read (foods, nutrient amounts, market prices and two
surveys).

Each view is one SQL text that is valid in both Spark SQL and DuckDB, so the
Spark side and the oracle side use the very same definition. Table names are
``{placeholders}``: on Spark they are bound to DataFrames through
``spark.sql(text, name=df)``, for DuckDB to the pre-registered view names.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# food: one row per food (fdc_id, description, category)
FOOD = """
SELECT p_partkey AS fdc_id, p_name AS description, p_size AS food_category_id FROM {part}
"""

# food_nutrient: long (fdc_id, nutrient_id, amount); (fdc_id, nutrient_id) repeats and
# (fdc_id, nutrient_id, ord1, ord2) is unique, so "first" is well defined.
FOOD_NUTRIENT = """
SELECT l_partkey AS fdc_id,
       CASE (l_linenumber-1) + 7*CAST(l_suppkey%2 AS int)
         WHEN 0 THEN 1003 WHEN 1 THEN 1004 WHEN 2 THEN 1005 WHEN 3 THEN 1008 WHEN 4 THEN 1079
         WHEN 5 THEN 1087 WHEN 6 THEN 1089 WHEN 7 THEN 1093 WHEN 8 THEN 1095 WHEN 9 THEN 1253
         WHEN 10 THEN 1258 WHEN 11 THEN 1292 WHEN 12 THEN 1293 WHEN 13 THEN 2000 END AS nutrient_id,
       CASE WHEN l_quantity=1 THEN NULL
            WHEN l_linenumber=1 AND l_suppkey%2=1 THEN l_quantity*20
            ELSE l_quantity END AS amount,
       l_orderkey AS ord1, l_extendedprice AS ord2
FROM {lineitem}
"""

# prices: one row per price observation; (producto, ord1..ord4) is unique. Two of
# three parts are sold under a name that no food has: a letter more, or one missing.
PRICES = """
SELECT CASE p_partkey%3 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name,'s')
       ELSE concat(substr(p_name,1,1),substr(p_name,3)) END AS producto, p_brand AS grupo, p_type AS unidad,
       l_extendedprice/l_quantity AS precio,
       l_orderkey AS ord1, l_extendedprice AS ord2, l_linenumber AS ord3, l_partkey AS ord4
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# survey_a: lab survey, one row per participant.
SURVEY_A = """
SELECT c_custkey AS seqn, 18+c_custkey%63 AS ridageyr,
       CASE WHEN c_acctbal<0 THEN NULL ELSE c_acctbal/2000 END AS indfmpir,
       18+(c_custkey*7%250)/10.0E0 AS bmxbmi, c_mktsegment AS categoria_imc,
       CASE WHEN c_nationkey=24 THEN NULL ELSE c_nationkey%6+1 END AS edad_grupo_brfss,
       CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%7=0 THEN 1 ELSE 0 END AS tiene_diabetes,
       CASE WHEN c_acctbal<2000 THEN 'Baja' WHEN c_acctbal<6000 THEN 'Media' ELSE 'Alta' END AS categoria_fibra,
       CASE WHEN c_acctbal<4000 THEN 'Alto' ELSE 'Bajo' END AS categoria_azucar,
       1+c_custkey%2 AS riagendr,
       CASE WHEN c_custkey%9=0 THEN NULL ELSE 4+(c_custkey*13%60)/10.0E0 END AS lbxgh,
       CASE WHEN c_custkey%8=0 THEN NULL WHEN c_custkey%3=0 THEN 1 ELSE 0 END AS colesterol_alto,
       CASE WHEN c_custkey%10=0 THEN NULL WHEN c_custkey%4=0 THEN 1 ELSE 0 END AS sindrome_metabolico,
       CASE WHEN c_custkey%17=0 THEN NULL ELSE 1200+c_custkey*31%2000 END AS promedio_tkcal,
       CASE WHEN c_custkey%13=0 THEN NULL ELSE (c_custkey*7%400)/10.0E0 END AS promedio_tfibe,
       CASE WHEN c_custkey%19=0 THEN NULL ELSE (c_custkey*11%6000)/10.0E0 END AS promedio_tchol,
       (c_custkey*3%1500)/10.0E0 AS promedio_tsugr,
       CASE WHEN c_custkey%63<22 THEN '18-39' WHEN c_custkey%63<42 THEN '40-59' ELSE '60+' END AS grupo_edad
FROM {customer}
"""

# survey_b: phone survey, one row per interview.
SURVEY_B = """
SELECT o_orderkey AS seqno, c_nationkey AS state,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 5 END AS age_g,
       c_mktsegment AS categoria_imc,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS tiene_diabetes,
       CASE WHEN o_orderkey%13=0 THEN NULL WHEN o_totalprice<150000 THEN 0 ELSE 1 END AS estilo_vida_saludable,
       CASE WHEN o_orderkey%5=0 THEN 1 WHEN o_orderkey%9=0 THEN NULL ELSE 2 END AS medcost1,
       20+(o_orderkey%200)/10.0E0 AS imc_real
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# fuzzy fixture, left side: product names that need normalising and matching
FUZZY_PRODUCTS = """
SELECT DISTINCT concat(lower(p_type),' ',p_name) AS producto FROM {part}
"""

VIEWS = {
    "food": FOOD,
    "food_nutrient": FOOD_NUTRIENT,
    "prices": PRICES,
    "survey_a": SURVEY_A,
    "survey_b": SURVEY_B,
    "fuzzy_products": FUZZY_PRODUCTS,
}

# which base tables each view reads
VIEW_TABLES = {
    "food": ("part",),
    "food_nutrient": ("lineitem",),
    "prices": ("lineitem", "part"),
    "survey_a": ("customer",),
    "survey_b": ("orders", "customer"),
    "fuzzy_products": ("part",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (Parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one adapter view as a lazy DataFrame over the Parquet scans."""
    tables = {t: table(spark, sf_dir, t) for t in VIEW_TABLES[name]}
    return spark.sql(VIEWS[name], **tables)


def food(spark, sf_dir):
    return view(spark, sf_dir, "food")


def food_nutrient(spark, sf_dir):
    return view(spark, sf_dir, "food_nutrient")


def prices(spark, sf_dir):
    return view(spark, sf_dir, "prices")


def survey_a(spark, sf_dir):
    return view(spark, sf_dir, "survey_a")


def survey_b(spark, sf_dir):
    return view(spark, sf_dir, "survey_b")


def fuzzy_products(spark, sf_dir):
    return view(spark, sf_dir, "fuzzy_products")


@lru_cache(maxsize=None)
def duckdb_view(name: str) -> str:
    """The same view text with DuckDB's pre-registered table names."""
    return VIEWS[name].format(**{t: t for t in BASE_TABLES}).strip()

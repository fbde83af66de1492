"""Registry of bound queries and the roles the given tables play.

A role is a list of SQL expressions that read the same in Spark and in DuckDB: both
sides start from the same input columns, and what is done with them is written
independently on each side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from assayframe.sources.tables import widen


@dataclass(frozen=True)
class Bound:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Bound] = {}


def bound(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Bound(name, run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table. ``spread_by`` is for queries with much work per row."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return widen(df, spread_by) if spread_by else df


@dataclass(frozen=True)
class Role:
    source: str
    columns: dict[str, str]

    def load(self, spark: SparkSession, sf_dir: str, spread_by: str | None = None) -> DataFrame:
        exprs = [f"{e} AS {n}" for n, e in self.columns.items()]
        return table(spark, sf_dir, self.source, spread_by).selectExpr(*exprs)

    def sql(self) -> str:
        exprs = ", ".join(f"{e} AS {n}" for n, e in self.columns.items())
        return f"SELECT {exprs} FROM {self.source}"


def _code(prefix: str, number: str) -> str:
    return f"'{prefix}' || lpad(cast({number} AS string), 6, '0')"


def pick(key: str, n: int, *values: str | None) -> str:
    """CASE that spreads the values over the remainders of a key."""
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'")
        for i, v in enumerate(values)
    )
    return f"CASE {key} % {n} {whens} END"


STUDIES = Role(
    "nation",
    {"study_pk": "cast(n_nationkey AS string)", "study_id": _code("ST", "n_nationkey")},
)
ANALYSES = Role(
    "supplier",
    {
        "analysis_pk": "cast(s_suppkey AS string)",
        "study_pk": "cast(s_nationkey AS string)",
        "analysis_id": _code("AN", "s_suppkey"),
        "file_id": "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'F' || s_suppkey END",
        "device": "CASE WHEN s_suppkey % 5 = 0 THEN 'GCMS' END",
    },
)
GROUPS = pick(
    "o_custkey",
    8,
    "Obese",
    "control",
    "case",
    "lean acute",
    "Obesity and HDL function",
    "pooled QC",
    "ob",
    "second visit",
)
MATRICES = pick(
    "o_orderkey", 7, "Blood Serum", "urine", "stool", "liver tissue", "plasma, urine", "n/a", "CSF"
)
SAMPLES = Role(
    "orders",
    {
        "sample_uid": _code("ST", "o_orderkey % 25") + " || ':O' || o_orderkey",
        "study_pk": "cast(o_orderkey % 25 AS string)",
        "sample_label": "'O' || o_orderkey",
        "factors_raw": "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 11 = 0 THEN '-' "
        f"ELSE 'Group:' || {GROUPS} || ' | Sample_Source : ' || {MATRICES} "
        "|| ' | Visit:' || o_custkey % 3 || ' | no colon here | status:' || "
        "CASE WHEN o_orderkey % 5 = 0 THEN 'healthy' WHEN o_orderkey % 5 = 1 THEN 'case: late' "
        "ELSE o_orderpriority END || CASE WHEN o_orderkey % 3 = 0 THEN '|GROUP:Normal weight' "
        "ELSE '' END END",
        "exposure": "CASE WHEN o_orderkey % 17 = 0 THEN 'OB' WHEN o_orderkey % 17 = 1 THEN '' END",
        "sample_matrix": "CASE WHEN o_orderkey % 19 = 0 THEN 'Urine' END",
    },
)
FEATURES = Role(
    "part",
    {
        "feature_uid": _code("AN", "p_partkey % 100") + " || ':met:' || p_partkey",
        "feature_type": "CASE WHEN p_size % 5 = 0 THEN 'nmr_bin' ELSE 'metabolite' END",
        "name_raw": "p_name",
        "refmet_name": "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END",
        "analysis_id": _code("AN", "p_partkey % 100"),
    },
)
SEG_EXPOSURE = pick(
    "doc_id", 7, "OB", "CON", "obese vs control", "BMI>30", "low_BMI", "healthy", "cohort"
)
SEG_MATRIX = pick(
    "doc_id",
    9,
    "serum",
    "urine",
    "stool",
    "csf",
    "plasma",
    "Fecal",
    "blood urine",
    "tissue",
    "x_serum_y",
)
SEG_DEVICE = pick(
    "doc_id",
    11,
    "NMR",
    "GC-MS",
    "GCMS",
    "GC",
    "LC MS",
    "UHPLC",
    "1H-NMR",
    "GC_EI",
    "HPLC",
    "data",
    "x_GC_y",
)
SEG_PLATFORM = pick(
    "doc_id",
    13,
    "ESI_pos",
    "esi-neg",
    "positive_mode",
    "HILIC",
    "C18 RP",
    "QQQ",
    "q-tof",
    "TripleTOF",
    "Orbitrap HILIC C8 UPLC",
    "a+ESI",
    "APCI pos",
    "x-ESI y",
    "run",
)
TYPES = pick(
    "doc_id",
    6,
    "mwtab",
    "mwtab_ms",
    "mwtab_nmr_binned",
    "metabo_table_html",
    "unknown",
    "nmr_binned_xlsx",
)
_PATH = f"source || '/' || lang || '/' || {SEG_EXPOSURE} || '/' || {SEG_MATRIX} || '/' || {SEG_DEVICE}"
_NAME = f"{SEG_PLATFORM} || ' ' || doc_id || '.txt'"
FILES = Role(
    "documents",
    {
        "file_id": "'F' || doc_id",
        "import_id": "source",
        "path_rel": f"CASE WHEN doc_id % 23 = 0 THEN NULL ELSE {_PATH} || '/' || {_NAME} END",
        "path_abs": f"'/data/' || {_PATH} || '/' || {_NAME}",
        "filename": _NAME,
        "ext": "'.txt'",
        "detected_type": f"CASE WHEN doc_id % 29 = 0 THEN NULL ELSE {TYPES} END",
        "device": "CASE WHEN doc_id % 10 < 3 THEN 'MS' END",
        "exposure": "CASE WHEN doc_id % 10 < 2 THEN 'CON' END",
        "sample_type": "CASE WHEN doc_id % 10 < 2 THEN 'Urine' END",
        "platform": "CASE WHEN doc_id % 10 < 1 THEN 'old' END",
        "parse_status": pick("doc_id", 4, "pending", "failed", "success", "skipped"),
        "parse_error": "CASE WHEN doc_id % 4 = 1 THEN 'old error' END",
        "parsed_at": "CASE WHEN doc_id % 4 = 2 THEN timestamp '2024-01-01 00:00:00' END",
        "created_at": "n_chars % 50",
        "size_bytes": "n_chars",
    },
)
MEASUREMENTS = Role(
    "lineitem",
    {
        "measurement_id": "l_orderkey || '-' || l_linenumber || '-' || l_partkey",
        "sample_uid": "CASE WHEN l_suppkey % 41 = 3 AND l_linenumber = 2 THEN 'ST999999:X' || l_orderkey % 9 "
        f"ELSE {_code('ST', 'l_orderkey % 25')} || ':O' || l_orderkey END",
        "feature_uid": "CASE WHEN l_partkey % 53 = 5 AND l_linenumber = 1 THEN 'AN999999:met:' || l_partkey "
        f"ELSE {_code('AN', 'l_partkey % 100')} || ':met:' || l_partkey END",
        "value": "CASE WHEN l_linenumber = 7 OR l_partkey % 31 = 0 THEN NULL "
        "WHEN l_quantity < 4 THEN -l_extendedprice ELSE l_extendedprice END",
        "unit": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag || l_linestatus END",
        "file_id": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'F' || l_partkey % 1100 END",
        "col_index": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linenumber END",
        "replicate_ix": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_suppkey % 3 + 1 END",
        "created_at": "l_shipdate",
    },
)
# as MEASUREMENTS, with NaN and infinities among the values
QC_MEASUREMENTS = Role(
    "lineitem",
    MEASUREMENTS.columns
    | {
        "value": "CASE WHEN l_suppkey % 29 = 1 THEN cast('NaN' AS double) "
        "WHEN l_suppkey % 29 = 2 THEN cast('Infinity' AS double) "
        "WHEN l_suppkey % 29 = 3 THEN cast('-Infinity' AS double) ELSE "
        + MEASUREMENTS.columns["value"]
        + " END"
    },
)

ROLES = {
    "studies": STUDIES,
    "analyses": ANALYSES,
    "samples": SAMPLES,
    "features": FEATURES,
    "files": FILES,
    "measurements": MEASUREMENTS,
}


def load(
    spark: SparkSession, sf_dir: str, *names: str, spread: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Tables by role. ``spread`` maps a role to the column its rows spread by."""
    spread = spread or {}
    return {n: ROLES[n].load(spark, sf_dir, spread.get(n)) for n in names or ROLES}


def ctes(*names: str, **more: str) -> str:
    """WITH clause over roles, followed by further named queries."""
    parts = [f"{n} AS ({ROLES[n].sql()})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"

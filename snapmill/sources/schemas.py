"""Declared table schemas, table creation, conforming inserts and post-write checks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.runtime import collect_bounded

# fixed values: declared columns of every warehouse table, one per line as
# NAME type [key] [part] [null]; "key" marks the primary key, "part" the partition column
RAW_CUSTOMER = """
CUST_ID bigint key
SNAP_DT date key part
NAME string
GENDER string
BIRTH_DT date null
PHONE string null
EMAIL string null
BLOOD_GRP string null
JOB string null
OFFICE string null
ADDRESS string null
ORG string null
TITLE string null
SINCE_DT date null
SALARY decimal(10,2)
BONUS decimal(10,2)
"""

RAW_ACCOUNT = """
CUST_ID bigint key
ACCT_ID string key
SNAP_DT date key part
ACCT_TYPE_CD string
END_BAL decimal(12,2)
DR_AMT decimal(12,2)
CR_AMT decimal(12,2)
CR_LMT decimal(12,2)
"""

RAW_EVENTS = """
CUST_ID bigint key
SNAP_DT date part
EVENT_TS timestamp key
EVENT_CD string
EVENT_CHANNEL string
"""

RAW_PURCHASES = """
CUST_ID bigint key
SNAP_DT date part
PUR_TS timestamp key
PUR_NUM bigint
PUR_AMT decimal(10,2)
"""

CUST_BASE = """
CUST_ID bigint key
SNAP_DT date key part
GENDER string
EMAIL_DOMAIN string null
BLOOD_GRP string null
SUPER_CITY boolean
COASTAL_CITY boolean
MANAGER_FLG boolean
TECHNICAL_FLG boolean
AGE tinyint null
TENURE tinyint null
TOTAL_COMP decimal(10,2)
BONUS_RATIO float
"""

ACCT_BASE = """
CUST_ID bigint key
SNAP_DT date key part
NUM_ACCTS_DEB tinyint
NUM_ACCTS_CRE tinyint
END_BAL_DEB decimal(12,2)
END_BAL_CRE decimal(12,2)
DR_AMT_DEB decimal(12,2)
DR_AMT_CRE decimal(12,2)
CR_AMT_DEB decimal(12,2)
CR_AMT_CRE decimal(12,2)
CR_LMT decimal(12,2)
"""

ACCT_WINDOW = """
CUST_ID bigint key
SNAP_DT date key part
MAX_NUM_ACCT_7D tinyint
TOTAL_FLOW_7D decimal(12,2)
DEB_CRE_FLOW_7D float
AVG_CR_UTIL_7D float
MAX_CR_UTIL_7D float
AVG_DR_DEB_3D float
AVG_CR_DEB_3D float
AVG_DR_CRE_3D float
AVG_CR_CRE_3D float
"""

EVENT_WINDOW = """
CUST_ID bigint key
SNAP_DT date key part
DAYS_SINCE_LAST_EVENT tinyint
NUM_EVENT_7D smallint
RATIO_EVENT_EMAIL float
RATIO_EVENT_CLICK float
RATIO_EVENT_DECLINE float
"""

# in the combined table the three event ratios may be null
EVENT_PART = EVENT_WINDOW.replace("CUST_ID bigint key\nSNAP_DT date key part\n", "").replace("float", "float null")
ACCT_PART = ACCT_WINDOW.replace("CUST_ID bigint key\nSNAP_DT date key part\n", "")
FEATURES = CUST_BASE + ACCT_PART + EVENT_PART

PURCHASE_WINDOW = """
CUST_ID bigint key
SNAP_DT date part
NUM_PUR_F7D bigint
TOTAL_PUR_NUM_F7D bigint
TOTAL_PUR_AMT_F7D decimal(10,2)
"""

SCORING = """
CUST_ID bigint key
SNAP_DT date key part
PROB_CLS0 double
PROB_CLS1 double
CALIB_CLS0 double
CALIB_CLS1 double
"""

TRAINING = FEATURES + """
CONV_7D tinyint
DATA_ID string key part
IS_TRAIN boolean part
"""

DECLARED = {
    ("RAW", "CUSTOMER"): RAW_CUSTOMER,
    ("RAW", "ACCOUNT"): RAW_ACCOUNT,
    ("RAW", "EVENTS"): RAW_EVENTS,
    ("RAW", "PURCHASES"): RAW_PURCHASES,
    ("EXTRACT", "CUSTOMER"): RAW_CUSTOMER,
    ("EXTRACT", "ACCOUNT"): RAW_ACCOUNT,
    ("EXTRACT", "EVENTS"): RAW_EVENTS,
    ("EXTRACT", "PURCHASES"): RAW_PURCHASES,
    ("FEATURE", "CUST_BASE"): CUST_BASE,
    ("FEATURE", "ACCT_BASE"): ACCT_BASE,
    ("FEATURE", "ACCT_WINDOW"): ACCT_WINDOW,
    ("FEATURE", "EVENT_WINDOW"): EVENT_WINDOW,
    ("FEATURE", "FEATURES"): FEATURES,
    ("TARGET", "PURCHASE_WINDOW"): PURCHASE_WINDOW,
    ("TARGET", "SCORING"): SCORING,
    ("TARGET", "TRAINING"): TRAINING,
}


_TYPES = {t.simpleString(): t for t in (
    T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.ByteType(), T.ShortType(), T.IntegerType(),
    T.LongType(), T.FloatType(), T.DoubleType())}


def _type_of(name: str) -> T.DataType:
    if name.startswith("decimal("):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]


def parse_schema(text: str) -> T.StructType:
    """StructType of a declaration; keys and partition columns are kept as field metadata."""
    fields = []
    for line in text.strip().splitlines():
        if not line.strip():
            continue
        name, dtype, *marks = line.split()
        fields.append(T.StructField(name, _type_of(dtype), "null" in marks,
                                    {"primary_key": "key" in marks, "partition_key": "part" in marks}))
    return T.StructType(fields)


def declared_schema(schema: str, table: str) -> T.StructType:
    if (schema, table) not in DECLARED:
        raise ValueError(f"no declared schema for {schema}.{table}")
    return parse_schema(DECLARED[(schema, table)])


def declared_columns(schema: str, table: str) -> list[str]:
    return declared_schema(schema, table).fieldNames()


# fixed values: type names of the schema documents
DOCUMENT_TYPES = {
    "String": "string", "Boolean": "boolean", "Date": "date", "Timestamp": "timestamp", "Int8": "tinyint", "Int16": "smallint",
    "Int32": "int", "Int64": "bigint", "Float32": "float", "Float64": "double",
}


def to_document(schema: T.StructType) -> dict[str, dict]:
    """The declared per-column form: {column: {dtype, args, descr, primary_key, partition_key}}."""
    names = {v: k for k, v in DOCUMENT_TYPES.items()}
    out = {}
    for f in schema:
        args: dict = {"nullable": f.nullable}
        if isinstance(f.dataType, T.DecimalType):
            dtype, args = "Decimal", {"precision": f.dataType.precision, "scale": f.dataType.scale, **args}
        else:
            dtype = names[f.dataType.simpleString()]
        out[f.name] = {"dtype": dtype, "args": args, "descr": f.metadata.get("descr", ""),
                       "primary_key": bool(f.metadata.get("primary_key")), "partition_key": bool(f.metadata.get("partition_key"))}
    return out


def from_document(document: dict[str, dict]) -> T.StructType:
    """The schema of a per-column document; what is left out is nullable, no key and not described."""
    fields = []
    for name, c in document.items():
        args = c.get("args", {})
        if c["dtype"] == "Decimal":
            dtype: T.DataType = T.DecimalType(args["precision"], args["scale"])
        elif c["dtype"] in DOCUMENT_TYPES:
            dtype = _TYPES[DOCUMENT_TYPES[c["dtype"]]]
        else:
            raise ValueError(f"unknown dtype {c['dtype']} of column {name}")
        marks = {k: bool(c.get(k, False)) for k in ("primary_key", "partition_key")}
        described = {"descr": c["descr"]} if c.get("descr") else {}
        fields.append(T.StructField(name, dtype, args.get("nullable", True), {**marks, **described}))
    return T.StructType(fields)


def write_schema_files(spark: SparkSession, root: str, schemas: dict[tuple[str, str], T.StructType] | None = None) -> None:
    """Write schemas (the declared ones by default) as <root>/<schema>/<table>.json, on any store Spark reads."""
    sc = spark.sparkContext
    for (schema, table), found in (schemas or {k: declared_schema(*k) for k in DECLARED}).items():
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{schema}/{table}.json")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps(to_document(found), indent=2).encode()))
        finally:
            out.close()


def read_schema_files(spark: SparkSession, root: str, max_tables: int = 10_000) -> dict[tuple[str, str], T.StructType]:
    """Schemas found as <root>/<schema>/<table>.json."""
    root = root.rstrip("/")
    documents = spark.read.text(f"{root}/*/*.json", wholetext=True)
    rows = collect_bounded(documents.select("value", F.col("_metadata.file_path").alias("path")), max_tables, "schema documents")
    found = {}
    for r in rows:
        schema, name = r.path.rsplit("/", 2)[1:]
        found[schema, name.removesuffix(".json")] = from_document(json.loads(r.value))
    return found


def key_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get("primary_key")]


def partition_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get("partition_key")]


def _quoted(name: str) -> str:
    return f"`{name}`"


def table_init(spark: SparkSession, database: str, table: str, schema: T.StructType, location: str) -> str:
    """Create the table at location if it is missing, partitioned by its partition columns."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{location.rstrip('/').rpartition('/')[0]}/{database}.db'")
    cols = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    parts = ", ".join(_quoted(c) for c in partition_columns(schema))
    by = f" PARTITIONED BY ({parts})" if parts else ""
    name = f"{_quoted(database)}.{_quoted(table)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{by} LOCATION '{location}'")
    return name


_DEFAULTS = {
    T.StringType: "",
    T.BooleanType: False,
    T.DateType: "1970-01-01",
    T.TimestampType: "1970-01-01",
    T.TimestampNTZType: "1970-01-01",
}


def _conformed(field: T.StructField) -> Column:
    source = F.col(field.name)
    # a double enters a decimal through its own decimal text: rounded half up, null if it does not fit
    value = source.try_cast(field.dataType)
    if not field.nullable:
        value = F.coalesce(value, F.lit(_DEFAULTS.get(type(field.dataType), 0)).cast(field.dataType))
    return value.alias(field.name)


def schema_conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared column order and types; a value that does not fit becomes null, and null becomes
    the type's default in a column declared non-null."""
    return df.select(*[_conformed(f) for f in schema])


def post_check(df: DataFrame, table: str, keys: list[str], non_null: list[str]) -> DataFrame:
    """Rows (table, check, n_bad): repeated keys, nulls in required columns, and an empty table."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in non_null])
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
                .agg(F.count_if(F.col("c") > 1).alias("n_bad"))
                .select(F.lit("pk_unique").alias("check"), "n_bad"))
    checks = F.array(
        F.struct(F.lit("not_empty").alias("check"), F.when(F.col("n") == 0, 1).otherwise(0).cast("bigint").alias("n_bad")),
        *[F.struct(F.lit(f"non_null:{c}").alias("check"), F.col(c).alias("n_bad")) for c in non_null])
    return (counts.select(F.inline(checks)).unionByName(repeated)
            .select(F.lit(table).alias("table"), "check", "n_bad"))

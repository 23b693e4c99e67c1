"""Operator inputs built from the driver's test tables.

These functions only *shape* rows of the given tables into the schemas the
operators expect (a call log, app configs, a durable queue, delivery
attempts, environment headers, stack traces). They do none of the
operators' work. Each mapping exists twice -- a Spark form and the same
mapping as a DuckDB SQL fragment used by the oracle queries -- and the two
must stay identical.

Fixed fixture choices (k = integer at ``$.k`` of ``events.props``):

* calls from events: install = user_id, seq = event_id;
  signup k<50 identify(user-(k%7)); signup k>=50 start_session, explicit
  actor user-(k%7) when k>=90; purchase k<5 opt_out, k<10 opt_in, k<15
  reset, k<60 end_session; view k in 31, 32 start and 36, 37 exit (of a
  process), 41 flush, 43 shutdown (an op nobody knows); error -> exception,
  fatal when k>=90; all other rows track(event_type, 'k'||(k%10)). Bad inputs: click k<5 uses category
  '_internal'; view k=13 passes explicit actor ''; view k=23 passes 513 x.
  source_app = the supplier name of user_id % 10, an app without a config
  row when user_id % 37 = 5. Customers start some installs opted out.
* app_config from supplier (flush s*50-10, batch s*20-5, breadcrumbs
  s*3-5, queue MB s*30-20 or 0 when s%3=1, url ftp://h when s%5=0 else http://h/).
* queue from orders (install = o_custkey % 20), attempts from lineitem,
  environment headers from customer, stack traces from conversations,
  long texts and property maps from documents, app names from pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------- calls

def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    # Parse the JSON once; every rule below reads the integer column.
    e = e.select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    n_conv = table(spark, sf_dir, "conversations").agg(F.max("conv_id")).first()[0] + 1
    k = F.col("k")
    et = F.col("event_type")
    op = (F.when((et == "signup") & (k < 50), "identify")
           .when(et == "signup", "start_session")
           .when((et == "purchase") & (k < 5), "opt_out")
           .when((et == "purchase") & (k < 10), "opt_in")
           .when((et == "purchase") & (k < 15), "reset")
           .when((et == "purchase") & (k < 60), "end_session")
           .when((et == "view") & k.isin(31, 32), "start")
           .when((et == "view") & k.isin(36, 37), "exit")
           .when((et == "view") & (k == 41), "flush")
           .when((et == "view") & (k == 43), "shutdown")
           .when(et == "error", "exception")
           .otherwise("track"))
    user = F.concat(F.lit("user-"), (k % 7).cast("string"))
    explicit = (F.when(op == "identify", user)
                 .when((op == "start_session") & (k >= 90), user)
                 .when((op == "track") & (et == "view") & (k == 13), F.lit(""))
                 .when((op == "track") & (et == "view") & (k == 23), F.repeat(F.lit("x"), 513)))
    category = F.when(op == "track", F.when((et == "click") & (k < 5), F.lit("_internal")).otherwise(et))
    name = F.when(op == "track", F.concat(F.lit("k"), (k % 10).cast("string")))
    props = F.when(op == "track", F.create_map(
        F.lit("k"), k.cast("string"), F.lit("type"), et,
        F.lit("bucket"), (k % 3).cast("string"), F.lit("empty"), F.lit(""),
    ))
    exc_type = F.when(op == "exception", F.element_at(
        F.array(F.lit("std::runtime_error"), F.lit("std::logic_error"), F.lit("std::out_of_range")),
        (k % 3 + 1).cast("int")))
    cols = [
        F.col("user_id").alias("install_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        category.alias("category"),
        name.alias("name"),
        explicit.alias("explicit_actor"),
        props.alias("properties"),
        exc_type.alias("exc_type"),
        F.when((op == "exception") & (k >= 90), F.lit("fatal")).alias("severity"),
        F.when(op == "exception", F.concat(F.lit("failure in "), et, F.lit(" #"), F.col("event_id").cast("string"),
                                           F.repeat(F.lit("."), k * 15))).alias("message"),
        F.when(op == "exception", F.col("event_id") % n_conv).alias("conv_id"),
        F.when(F.col("user_id") % 37 == 5, F.lit("Unlisted App")).otherwise(F.format_string("Supplier#%09d", F.col("user_id") % 10)).alias("source_app"),
    ]
    # Exceptions (errors) carry the trace of conversation event_id % (number of
    # conversations). Only they are joined: the other calls all have the null
    # key, which a shuffled join would deal to one task.
    carries = F.coalesce(et == "error", F.lit(False)) & F.col("event_id").isNotNull()
    traced = e.filter(carries).select(*cols).join(stack_traces(spark, sf_dir), "conv_id", "left")
    plain = e.filter(~carries).select(*cols).withColumn("stack_trace", F.lit(None).cast("string"))
    order = [c for c in plain.columns if c not in ("conv_id", "stack_trace", "source_app")] + ["stack_trace", "source_app"]
    return traced.select(*order).unionByName(plain.select(*order))


TRACES_SQL = r"""
traces AS (
  SELECT conv_id, string_agg(CASE WHEN turn % 7 = 6 THEN '?? ' || role
      WHEN conv_id % 3 = 0 THEN '[' || turn || '] ' || role || CASE WHEN turn % 4 = 3 THEN '' ELSE ' (conv' || conv_id || '.cpp:' || length(text) || ')' END
      WHEN conv_id % 3 = 1 THEN turn || '   libconv' || conv_id || '.dylib   0x' || printf('%x', conv_id + 4096) || ' ' || role || ' + ' || length(text)
      ELSE '/opt/libconv' || conv_id || '.so' || CASE turn % 3 WHEN 0 THEN '(' || role || '+0x' || printf('%x', length(text)) || ')'
        WHEN 1 THEN '(+0x' || printf('%x', length(text)) || ')' ELSE '' END || ' [0x' || printf('%x', conv_id + 4096) || ']' END,
    chr(10) ORDER BY turn) AS stack_trace
  FROM conversations GROUP BY conv_id
)"""


CALLS_SQL = TRACES_SQL + r""",
calls_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
calls_op AS (
  SELECT *, CASE
      WHEN event_type = 'signup' AND k < 50 THEN 'identify'
      WHEN event_type = 'signup' THEN 'start_session'
      WHEN event_type = 'purchase' AND k < 5 THEN 'opt_out'
      WHEN event_type = 'purchase' AND k < 10 THEN 'opt_in'
      WHEN event_type = 'purchase' AND k < 15 THEN 'reset'
      WHEN event_type = 'purchase' AND k < 60 THEN 'end_session'
      WHEN event_type = 'view' AND k IN (31, 32) THEN 'start'
      WHEN event_type = 'view' AND k IN (36, 37) THEN 'exit'
      WHEN event_type = 'view' AND k = 41 THEN 'flush'
      WHEN event_type = 'view' AND k = 43 THEN 'shutdown'
      WHEN event_type = 'error' THEN 'exception'
      ELSE 'track' END AS op
  FROM calls_k
),
calls AS (
  SELECT user_id AS install_id, CAST(ts AS TIMESTAMP) AS ts, event_id AS seq, op,
    CASE WHEN op = 'track' THEN CASE WHEN event_type = 'click' AND k < 5 THEN '_internal' ELSE event_type END END AS category,
    CASE WHEN op = 'track' THEN 'k' || CAST(k % 10 AS VARCHAR) END AS name,
    CASE WHEN op = 'identify' THEN 'user-' || CAST(k % 7 AS VARCHAR)
         WHEN op = 'start_session' AND k >= 90 THEN 'user-' || CAST(k % 7 AS VARCHAR)
         WHEN op = 'track' AND event_type = 'view' AND k = 13 THEN ''
         WHEN op = 'track' AND event_type = 'view' AND k = 23 THEN repeat('x', 513) END AS explicit_actor,
    CASE WHEN op = 'track' THEN MAP {'k': CAST(k AS VARCHAR), 'type': event_type,
         'bucket': CAST(k % 3 AS VARCHAR), 'empty': ''} END AS properties,
    CASE WHEN op = 'exception' THEN (['std::runtime_error', 'std::logic_error', 'std::out_of_range'])[k % 3 + 1] END AS exc_type,
    CASE WHEN op = 'exception' AND k >= 90 THEN 'fatal' END AS severity,
    CASE WHEN op = 'exception' THEN 'failure in ' || event_type || ' #' || CAST(event_id AS VARCHAR) || repeat('.', k * 15) END AS message,
    t.stack_trace,
    CASE WHEN user_id % 37 = 5 THEN 'Unlisted App' ELSE printf('Supplier#%09d', user_id % 10) END AS source_app
  FROM calls_op LEFT JOIN traces t ON op = 'exception' AND t.conv_id = event_id % (SELECT max(conv_id) + 1 FROM conversations)
)"""


# ---------------------------------------------------------------- app config

def app_config_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    # Every fourth app has a second, older row.
    s = s.withColumn("old", F.explode(F.when(k % 4 == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    return s.select(
        F.col("s_name").alias("app_name"),
        F.concat(F.lit("key-"), k.cast("string")).alias("api_key"),
        F.when(k % 5 == 0, F.lit("ftp://h")).otherwise(F.lit("http://h/")).alias("api_base_url"),
        F.when(F.col("old"), F.lit("1.9")).otherwise(F.concat(F.lit("1."), (k % 3 + 10).cast("string"))).alias("app_version"),
        (~F.col("old")).alias("enabled"),
        (k * 50 - 10).cast("int").alias("flush_interval_seconds"),
        (k * 20 - 5).cast("int").alias("max_batch_size"),
        F.when(k % 3 == 1, 0).otherwise(k * 30 - 20).cast("int").alias("max_queue_size_mb"),
        (k * 3 - 5).cast("int").alias("max_breadcrumbs"),
    )


APP_CONFIG_SQL = r"""
app_config_raw AS (
  SELECT s_name AS app_name, 'key-' || CAST(s_suppkey AS VARCHAR) AS api_key,
    CASE WHEN s_suppkey % 5 = 0 THEN 'ftp://h' ELSE 'http://h/' END AS api_base_url,
    CASE WHEN old THEN '1.9' ELSE '1.' || CAST(s_suppkey % 3 + 10 AS VARCHAR) END AS app_version, NOT old AS enabled,
    CAST(s_suppkey * 50 - 10 AS INTEGER) AS flush_interval_seconds,
    CAST(s_suppkey * 20 - 5 AS INTEGER) AS max_batch_size,
    CAST(CASE WHEN s_suppkey % 3 = 1 THEN 0 ELSE s_suppkey * 30 - 20 END AS INTEGER) AS max_queue_size_mb,
    CAST(s_suppkey * 3 - 5 AS INTEGER) AS max_breadcrumbs
  FROM (SELECT *, FALSE AS old FROM supplier UNION ALL SELECT *, TRUE FROM supplier WHERE s_suppkey % 4 = 1)
)"""


# --------------------------------------------------------------------- queue

def queue(spark: SparkSession, sf_dir: str, installs: int = 20) -> DataFrame:
    """Durable queue; the installs use the apps of every third supplier."""
    o = table(spark, sf_dir, "orders")
    payload = F.format_string(
        '{"actor_id":"cust-%d","category":"order","event_id":"ord-%d","name":"%s",'
        '"source_app":"shop","source_version":"1.0","timestamp":"%s"}',
        F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderpriority"),
        F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return o.select(
        (F.col("o_custkey") % installs).alias("install_id"),
        F.col("o_orderkey").alias("id"),
        payload.alias("payload_json"),
        (F.col("o_orderdate").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 1000).cast("decimal(18,6)"))).alias("queued_at"),
        F.lit(0).alias("retry_count"),
        F.col("o_orderstatus").alias("o_orderstatus"),
        F.format_string("Supplier#%09d", 1 + 3 * (F.col("o_custkey") % installs % 8)).alias("app"),
    )


QUEUE_SQL = r"""
queue AS (
  SELECT o_custkey % 20 AS install_id, o_orderkey AS id,
    printf('{"actor_id":"cust-%d","category":"order","event_id":"ord-%d","name":"%s","source_app":"shop","source_version":"1.0","timestamp":"%s"}',
           o_custkey, o_orderkey, o_orderpriority, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%gZ')) AS payload_json,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 1000) AS queued_at, 0 AS retry_count, o_orderstatus,
    printf('Supplier#%09d', 1 + 3 * (o_custkey % 20 % 8)) AS app
  FROM orders
)"""


# ------------------------------------------------------------------ attempts

def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
    m = F.col("l_partkey") % 20
    status = (F.when(m < 10, 200).when(m < 12, 500).when(m == 12, 503).when(m == 13, 429)
               .when(m == 14, 0).when(m == 15, 401).when(m == 16, 402).when(m == 17, 400)
               .when(m == 18, 404).otherwise(304))
    s4 = F.col("l_suppkey") % 4
    retry_after = F.when(m == 13, F.when(s4 == 0, F.col("l_suppkey").cast("string"))
                         .when(s4 == 1, F.concat(F.lit(" "), (F.col("l_suppkey") * 10).cast("string")))
                         .when(s4 == 2, F.lit("Wed, 21 Oct 2015 07:28:00 GMT"))
                         .otherwise(F.lit("-5")))
    rn = F.row_number().over(w) - 1
    return li.select(
        (F.col("l_orderkey") % 50).alias("install_id"),
        F.col("l_orderkey").alias("batch_id"),
        rn.cast("int").alias("attempt_no"),
        F.when(F.col("l_linestatus") == "O", "memory").otherwise("durable").alias("origin"),
        status.cast("int").alias("status_code"),
        (m == 14).alias("is_network_error"),
        retry_after.alias("retry_after"),
        (F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), rn.cast("decimal(18,6)"))).alias("attempted_at"),
        F.col("l_quantity").cast("int").alias("n_events"),
    )


ATTEMPTS_SQL = r"""
attempts AS (
  SELECT l_orderkey % 50 AS install_id, l_orderkey AS batch_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS INTEGER) AS attempt_no,
    CASE WHEN l_linestatus = 'O' THEN 'memory' ELSE 'durable' END AS origin,
    CAST(CASE WHEN l_partkey % 20 < 10 THEN 200 WHEN l_partkey % 20 < 12 THEN 500
         WHEN l_partkey % 20 = 12 THEN 503 WHEN l_partkey % 20 = 13 THEN 429
         WHEN l_partkey % 20 = 14 THEN 0 WHEN l_partkey % 20 = 15 THEN 401
         WHEN l_partkey % 20 = 16 THEN 402 WHEN l_partkey % 20 = 17 THEN 400
         WHEN l_partkey % 20 = 18 THEN 404 ELSE 304 END AS INTEGER) AS status_code,
    l_partkey % 20 = 14 AS is_network_error,
    CASE WHEN l_partkey % 20 = 13 THEN CASE WHEN l_suppkey % 4 = 0 THEN CAST(l_suppkey AS VARCHAR)
         WHEN l_suppkey % 4 = 1 THEN ' ' || CAST(l_suppkey * 10 AS VARCHAR)
         WHEN l_suppkey % 4 = 2 THEN 'Wed, 21 Oct 2015 07:28:00 GMT' ELSE '-5' END END AS retry_after,
    CAST(l_shipdate AS TIMESTAMP) + to_seconds(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1) AS attempted_at,
    CAST(l_quantity AS INTEGER) AS n_events
  FROM lineitem
)"""


# -------------------------------------------------------------- environments

# Fixed fixture values: OS per market segment.
OS_BY_SEGMENT = {"AUTOMOBILE": "Windows", "BUILDING": "Linux", "FURNITURE": "macOS",
                 "HOUSEHOLD": "Linux", "MACHINERY": "Windows"}


def environment_headers(spark: SparkSession, sf_dir: str, installs: int = 500) -> DataFrame:
    """Base64 JSON environment headers, several per install over time."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    os_name = F.coalesce(*[F.when(seg == k, F.lit(v)) for k, v in OS_BY_SEGMENT.items()], F.lit("Unknown"))
    env = F.struct(
        ((F.col("c_custkey") % 16) + 1).cast("int").alias("cpu_core_count"),
        F.lit("en_US").alias("locale"),
        F.sha2(F.col("c_name"), 256).alias("machine_name_hash"),
        F.lit("x86_64").alias("os_architecture"),
        os_name.alias("os_name"),
        F.concat(F.lit("10."), (F.col("c_nationkey") % 5).cast("string")).alias("os_version"),
        F.lit("cpp").alias("runtime_name"),
        F.lit("17").alias("runtime_version"),
        ((F.col("c_custkey") * 37) % 65536).cast("long").alias("total_ram_mb"),
    )
    return c.select(
        (F.col("c_custkey") % installs).alias("install_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("c_custkey").cast("decimal(18,6)"))).alias("reported_at"),
        F.base64(F.to_json(env).cast("binary")).alias("env_header"),
        F.col("c_name").alias("c_name"),
    )


# ------------------------------------------------------------------- traces

def stack_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-line trace per conversation, in the form of one platform
    (``conv_id % 3``): Windows with and without a file, macOS, Linux with a
    symbol, an offset alone or neither; and lines of no form."""
    cv = table(spark, sf_dir, "conversations")
    turn, conv, size = F.col("turn"), F.col("conv_id"), F.length("text")
    windows = F.when(turn % 4 == 3, F.format_string("[%d] %s", turn, F.col("role"))).otherwise(
        F.format_string("[%d] %s (conv%d.cpp:%d)", turn, F.col("role"), conv, size))
    mac = F.format_string("%d   libconv%d.dylib   0x%x %s + %d", turn, conv, conv + 4096, F.col("role"), size)
    linux = F.when(turn % 3 == 0, F.format_string("/opt/libconv%d.so(%s+0x%x) [0x%x]", conv, F.col("role"), size, conv + 4096)) \
             .when(turn % 3 == 1, F.format_string("/opt/libconv%d.so(+0x%x) [0x%x]", conv, size, conv + 4096)) \
             .otherwise(F.format_string("/opt/libconv%d.so [0x%x]", conv, conv + 4096))
    line = (F.when(turn % 7 == 6, F.format_string("?? %s", F.col("role"))).when(conv % 3 == 0, windows)
             .when(conv % 3 == 1, mac).otherwise(linux))
    return (cv.groupBy("conv_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))),
                                            lambda x: x["l"]), "\n").alias("stack_trace")))


# ---------------------------------------------------------------- documents

def document_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property maps from whole documents: an entry per word, the full text
    under ``body``, one empty value and two keys equal in their first 64
    characters."""
    d = table(spark, sf_dir, "documents")
    words = F.split(F.col("text"), " ")
    entries = F.transform(words, lambda w, i: F.struct(F.concat(F.lit("key"), F.lpad((i + 1).cast("string"), 7, "0")).alias("key"), w.alias("value")))
    extra = F.array(
        F.struct(F.lit("body").alias("key"), F.col("text").alias("value")),
        F.struct(F.lit("empty").alias("key"), F.lit("").alias("value")),
        F.struct(F.concat(F.lit("z" * 64), F.lit("a")).alias("key"), F.lit("first").alias("value")),
        F.struct(F.concat(F.lit("z" * 64), F.lit("b")).alias("key"), F.lit("second").alias("value")),
    )
    return d.select("doc_id", F.map_from_entries(F.concat(entries, extra)).alias("properties"),
                    F.col("text"))


DOC_PROPS_SQL = r"""
doc_props AS (
  SELECT doc_id, text, map_from_entries(list_concat(
    list_transform(string_split(text, ' '), lambda w, i: {'key': 'key' || lpad(CAST(i AS VARCHAR), 7, '0'), 'value': w}),
    [{'key': 'body', 'value': text}, {'key': 'empty', 'value': ''},
     {'key': repeat('z', 64) || 'a', 'value': 'first'}, {'key': repeat('z', 64) || 'b', 'value': 'second'}])) AS properties
  FROM documents
)"""


def initial_consent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Installs that start opted out: from customers."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 11 == 3)
    return c.select((F.col("c_custkey") % 500).alias("install_id"), F.lit(True).alias("opted_out")).distinct()


INITIAL_CONSENT_SQL = r"""
starts_opted_out AS (SELECT DISTINCT c_custkey % 500 AS install_id, TRUE AS opted_out FROM customer WHERE c_custkey % 11 = 3)"""


def app_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("app_name"))


# -------------------------------------------------------------- definitions

# Fixed fixture values: categories of declared event definitions.
DEFINITION_CATEGORIES = ["click", "view", "purchase", "app", "inventory"]


def declared_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared (category, name) pairs, one per part row; names empty when
    p_partkey % 7 = 0 (refused by the builder); the parts that would
    declare (purchase, k2) declare (purchase, k2_legacy) instead, so
    (purchase, k2) events are undeclared."""
    p = table(spark, sf_dir, "part")
    cat = F.element_at(F.array(*[F.lit(c) for c in DEFINITION_CATEGORIES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = (F.when(F.col("p_partkey") % 7 == 0, F.lit(""))
             .when(F.col("p_partkey") % 60 == 2, F.lit("k2_legacy"))
             .otherwise(F.concat(F.lit("k"), (F.col("p_partkey") % 12).cast("string"))))
    return p.select(F.format_string("Supplier#%09d", F.col("p_partkey") % 10).alias("source_app"),
                    cat.alias("category"), name.alias("name"))


DEFINITIONS_SQL = r"""
declared AS (
  SELECT printf('Supplier#%09d', p_partkey % 10) AS source_app,
    (['click', 'view', 'purchase', 'app', 'inventory'])[p_partkey % 5 + 1] AS category,
    CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 60 = 2 THEN 'k2_legacy'
         ELSE 'k' || CAST(p_partkey % 12 AS VARCHAR) END AS name
  FROM part
)"""

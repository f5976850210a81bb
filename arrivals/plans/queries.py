"""Driver query map: one query per operator, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL of the same key in ``arrivals.plans.oracle``. Queries that
exercise sinks write under the shared scratch folder (``spark.checkpoint.dir``)
and return a DataFrame read back from what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from arrivals.functions.columns import (
    day_number_to_date,
    normalise_text,
    parse_date,
    recode,
    substring_from,
    text_to_int,
    upper_case,
)
from arrivals.operators.aggregate import (
    aggregate_by_state,
    group_avg_first,
    mean_states,
    means,
    null_profile,
    row_count,
    sum_by_state_and_group,
)
from arrivals.operators.clean import (
    drop_columns,
    drop_missing,
    filter_equals,
    preview,
    rename_columns,
    select_columns,
)
from arrivals.operators.decode import checked_broadcast, decode, decode_hybrid, decode_roles
from arrivals.operators.quality import (
    contract_key_report,
    duplicate_keys,
    key_summary,
    non_empty_report,
    schema_report,
    unmatched_code_list,
    unmatched_codes,
)
from arrivals.operators.star import count_per_key, star_link, to_link_grain
from arrivals.plans import driver_tables as dt
from arrivals.plans.builds import (
    CONTRACTS,
    Lookups,
    arrivals_decode_report,
    build_airports,
    build_arrivals,
    build_demographics,
    build_temperature,
    publish,
    published_keys_across_months,
    read_published,
)
from arrivals.plans.codebooks import MODE_CODES, MODE_RECODE, VISA_RECODE, lookup_frame, mode_lookup
from arrivals.plans.ledger import applied_loads
from arrivals.plans.load import load_tables
from arrivals.plans.month_states import published_profile, published_state_month
from arrivals.plans.star_views import arrivals_by_state_month, enriched_arrivals
from arrivals.session import scratch_path, unique_table_name
from arrivals.streaming.monthly import load_new_drops
from arrivals.sources.checked import read_checked
from arrivals.sources.checked import split as split_checked
from arrivals.sources.readers import read_delimited, read_inferred, read_lookup, read_parquet, read_table
from arrivals.sources.sinks import (
    append_by_name,
    conform,
    create_table,
    read_rejects,
    refresh_months,
    replace_table,
    staged,
    write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Event-type book for the string-key decodes: four of the five types on
# purpose, so one type stays unmatched.
EVENT_TYPE_CODES = [("click", "Click"), ("view", "Page view"), ("purchase", "Purchase"), ("signup", "Sign-up")]

T = dt.table


# --- flagship ----------------------------------------------------------------

def nation_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation (+ region) at nation grain: link_key, nation, region."""
    n = T(spark, sf_dir, "nation")
    r = checked_broadcast(T(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return to_link_grain(nr, "n_nationkey", {"nation": F.min("n_name"), "region": F.min("r_name")})


def arrivals_by_nation_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals (orders) per residence nation, region and month.

    Orders are shuffled once, for the join to customer (AQE splits a hot
    customer); few orders share a customer and a month, so combining them
    before the join would only add a shuffle. The aggregation then sends one
    partial row per task, nation and month.
    """
    o = T(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    fact = o.join(c, o.o_custkey == c.c_custkey, "left")
    # The nation-grain dimension has at most one row per nation row: check the
    # bound on the nation table itself instead of computing the join twice.
    fact = star_link(fact, "c_nationkey", nation_dimension(spark, sf_dir), size_source=T(spark, sf_dir, "nation"))
    return fact.groupBy("nation", "region", "year", "month").agg(
        F.count(F.lit(1)).alias("n_arrivals"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


# --- scans (S1-S6) -------------------------------------------------------------

def scan_csv_header(spark, sf_dir):
    src = T(spark, sf_dir, "customer")
    path = scratch_path(spark, "scan_csv_header")
    src.write.option("header", "true").csv(path)
    return conform(read_delimited(spark, path, src.columns), src.schema)


def scan_csv_mixed_headers(spark, sf_dir):
    """customer as files of one folder, each with its own column order and header case."""
    src = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "scan_csv_mixed_headers")
    for i in range(3):
        part = src.where(F.col("c_custkey") % 3 == i)
        order = src.columns[i:] + src.columns[:i]
        named = part.select(*[F.col(c).alias(c.upper() if i == 2 else c) for c in order])
        named.write.mode("append").option("header", "true").csv(path)
    return conform(read_delimited(spark, path, src.columns), src.schema)


def scan_csv_rejects(spark, sf_dir):
    """S1 with its reject channel: orders as CSV lines, some with a field too many, one too few, or a quote that does
    not end. One row per line: the good ones' columns, the malformed ones' problem and raw text."""
    key = F.col("o_orderkey")
    fields = [key.cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")]
    line = (
        F.when(key % 50 == 0, F.concat_ws(",", *fields, F.lit("extra"))).when(key % 51 == 0, F.concat_ws(",", *fields[:2]))
        .when(key % 53 == 0, F.concat_ws(",", *fields[:2], F.concat(F.lit('"'), fields[2])))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = scratch_path(spark, "csv_rejects")
    columns = ["key", "status", "priority"]
    # One text column, unquoted, whose name is the header line.
    T(spark, sf_dir, "orders").select(line.alias(",".join(columns))).write.options(
        header="true", sep="\x01", quote="\0").csv(path)
    checked = staged(read_checked(spark, path, columns), "csv_checked")
    good, rejects = split_checked(checked)
    none = F.lit(None).cast("string")
    return good.select(*columns, none.alias("problem"), none.alias("line")).unionByName(
        rejects.select(*[none.alias(c) for c in columns], "problem", "line"))


def scan_csv_semicolon(spark, sf_dir):
    src = T(spark, sf_dir, "nation")
    path = scratch_path(spark, "scan_csv_semicolon")
    src.write.option("header", "true").option("sep", ";").csv(path)
    return conform(read_delimited(spark, path, src.columns, sep=";"), src.schema)


def scan_by_format(spark, sf_dir):
    src = T(spark, sf_dir, "supplier")
    parts = []
    for fmt in ("csv", "json", "orc", "parquet"):
        path = scratch_path(spark, f"scan_by_format_{fmt}")
        w = src.write.format(fmt)
        if fmt == "csv":
            w = w.option("header", "true")
        w.save(path)
        df = read_table(spark, path, fmt, columns=src.columns, schema=src.schema if fmt == "json" else None)
        parts.append(conform(df, src.schema).select(F.lit(fmt).alias("format"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan_csv_inferred(spark, sf_dir):
    src = T(spark, sf_dir, "part")
    path = scratch_path(spark, "scan_csv_inferred")
    src.write.option("header", "true").csv(path)
    return conform(read_inferred(spark, path), src.schema)


def scan_lookup_quoted(spark, sf_dir):
    book = T(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Code"), F.concat("n_name", F.lit(", PRC")).alias("Country")
    )
    path = scratch_path(spark, "scan_lookup_quoted")
    book.write.option("header", "true").csv(path)
    return read_lookup(spark, path)


def scan_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/region.parquet", ["r_regionkey", "r_name"])


# --- sinks (W1-W5) -------------------------------------------------------------

def sink_parquet_overwrite(spark, sf_dir):
    src = T(spark, sf_dir, "supplier")
    path = scratch_path(spark, "sink_parquet_overwrite")
    write_parquet(src.where(F.col("s_nationkey") < 5), path)
    write_parquet(src, path, mode="overwrite")
    return read_parquet(spark, path)


def _stored(spark, name, path) -> DataFrame:
    """What an external table holds; the catalog entry is dropped, the files stay to be read."""
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def load_append_by_name(spark, sf_dir):
    src = T(spark, sf_dir, "orders")
    name = unique_table_name("orders_load")
    path = scratch_path(spark, name)
    create_table(spark, name, src.schema, path=path)
    early = F.coalesce(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
    append_by_name(src.where(early), name)
    append_by_name(src.where(~early).select(*reversed(src.columns)), name)
    return _stored(spark, name, path)


def conform_schema(spark, sf_dir):
    src = T(spark, sf_dir, "customer")
    shuffled = src.select(
        F.lit("ignored").alias("extra"), *[F.col(c).cast("string").alias(c) for c in reversed(src.columns)]
    )
    # A new StructType: ``StructType.add`` would mutate the frame's cached schema.
    contract = StructType([*src.schema.fields, StructField("c_comment", StringType(), True)])
    return conform(shuffled, contract)


def table_replace(spark, sf_dir):
    src = T(spark, sf_dir, "nation")
    name = unique_table_name("nation_dim")
    path = scratch_path(spark, name)
    replace_table(src.where(F.col("n_regionkey") == 0), name, path)
    replace_table(src, name, path)
    return _stored(spark, name, path)


def refresh_month(spark, sf_dir):
    """A month is corrected and the correction repeated; both loads also hold rows without a month."""
    no_month = F.col("o_orderkey") % 97 == 0
    src = T(spark, sf_dir, "orders").withColumns(
        {"year": F.when(~no_month, F.year("o_orderdate")), "month": F.when(~no_month, F.month("o_orderdate"))}
    )
    late = F.coalesce(no_month & (F.col("o_orderkey") % 2 == 0), F.lit(False))
    path = scratch_path(spark, "refresh_month")
    refresh_months(src.where(~late), path, load="first")
    changed = src.where((F.col("year") == 1997) & (F.col("month") == 5)).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    ).unionByName(src.where(late))
    refresh_months(changed, path, load="second")
    refresh_months(changed, path, load="second")  # re-run: must not duplicate the month or the rejects
    return read_parquet(spark, path).unionByName(read_rejects(spark, path, src.schema).drop("load"))


# --- projections and filters ---------------------------------------------------

def rename_columns_q(spark, sf_dir):
    return rename_columns(
        T(spark, sf_dir, "customer"),
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id", "c_phone": "phone"},
    )


def drop_columns_q(spark, sf_dir):
    return drop_columns(T(spark, sf_dir, "lineitem"), ["l_tax", "l_linestatus", "l_comment"])


def select_columns_q(spark, sf_dir):
    return select_columns(T(spark, sf_dir, "part"), ["p_partkey", "p_brand", "p_size"])


def preview_rows(spark, sf_dir):
    return preview(T(spark, sf_dir, "orders"), 10, ["o_orderkey"])


def _documents_labels(spark, sf_dir) -> DataFrame:
    d = T(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


def drop_null_single(spark, sf_dir):
    return drop_missing(_documents_labels(spark, sf_dir), ["quality"])


def drop_null_any(spark, sf_dir):
    df = _documents_labels(spark, sf_dir).withColumn("toxic_flag", F.nullif(F.col("toxic"), F.lit(1)))
    return drop_missing(df, ["quality", "toxic_flag"])


def filter_equals_q(spark, sf_dir):
    return filter_equals(T(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


# --- decodes (J1-J5) -----------------------------------------------------------

def _decoded_documents(spark, sf_dir) -> DataFrame:
    """Both labels of a document: one scan, reduction and join of the book."""
    d = T(spark, sf_dir, "documents").select("doc_id", "lang")
    return decode(d, "doc_id", T(spark, sf_dir, "labels"), ["quality", "toxic"], lookup_code="doc_id",
                  lookup_label=["quality", "toxic"], key_type="raw", keep_code=True)


def decode_int_text(spark, sf_dir):
    """J1/J2 as the fact build keys them: decimal text codes ("2.0"), bad text and nulls against an integer book."""
    k = F.col("o_custkey")
    code = F.when(k % 7 == 5, F.lit("x")).when(k % 7 != 6, F.concat((k % 7).cast("string"), F.lit(".0")))
    o = T(spark, sf_dir, "orders").select("o_orderkey", code.alias("mode_code"))
    return decode(o, "mode_code", mode_lookup(spark), "mode", key_type="int", keep_code=True,
                  known_rows=len(MODE_CODES), unique_codes=True)


def decode_left(spark, sf_dir):
    return _decoded_documents(spark, sf_dir)


def _decoded_events(spark, sf_dir, default=None) -> DataFrame:
    e = T(spark, sf_dir, "events").select("event_id", "event_type")
    book = lookup_frame(spark, EVENT_TYPE_CODES)
    return decode(e, "event_type", book, "event_label", key_type="string", default=default, keep_code=True,
                  known_rows=len(EVENT_TYPE_CODES), unique_codes=True)


def decode_string_key(spark, sf_dir):
    return _decoded_events(spark, sf_dir)


def decode_with_default(spark, sf_dir):
    return _decoded_events(spark, sf_dir, default="other")


def decode_role_playing(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = T(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Resolve order -> customer nation on the orders side first, so lineitem
    # is shuffled once by order key (and once by supplier key) instead of
    # once more by customer key; left joins keep every lineitem row either way.
    order_nation = o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "c_nationkey")
    df = (
        li.join(order_nation, li.l_orderkey == order_nation.o_orderkey, "left")
        .join(s, li.l_suppkey == s.s_suppkey, "left")
    )
    df = decode_roles(df, dt.country_lookup(spark, sf_dir), {"c_nationkey": "cust_nation", "s_nationkey": "supp_nation"})
    return df.select("l_orderkey", "l_linenumber", "cust_nation", "supp_nation")


# --- aggregations (A1-A4) --------------------------------------------------------

def group_avg_first_q(spark, sf_dir):
    df = group_avg_first(T(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", ["c_name", "c_custkey"],
                         out_group="segment", out_value="avg_acctbal")
    return df.withColumn("avg_acctbal", F.round("avg_acctbal", 4))


def row_count_q(spark, sf_dir):
    return row_count(T(spark, sf_dir, "lineitem"))


def null_profile_q(spark, sf_dir):
    """Wide columns only matter as null or not: reduce them to a flag before the join."""
    d = T(spark, sf_dir, "documents").select(
        "doc_id", *[F.when(F.col(c).isNotNull(), True).alias(c) for c in ("text", "lang", "source", "n_chars")])
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    df = d.join(lab, "doc_id", "left")
    return null_profile(df, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])


def aggregate_by_state_q(spark, sf_dir):
    df = aggregate_by_state(T(spark, sf_dir, "customer"), "c_nationkey", ["c_mktsegment"],
                            {"acctbal": "c_acctbal"}, n_cities="n_segments")
    return df.withColumn("acctbal", F.round("acctbal", 2))


def aggregate_race_by_state_q(spark, sf_dir):
    df = sum_by_state_and_group(T(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", "c_acctbal")
    return df.withColumn("c_acctbal", F.round("c_acctbal", 2))


# --- scalar functions (X1-X7) ----------------------------------------------------

def _mixed_number_text() -> "F.Column":
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    return (
        F.when(k % 5 == 0, F.concat(n, F.lit(".0")))
        .when(k % 5 == 1, F.concat(F.lit("-"), n, F.lit(".7")))
        .when(k % 5 == 2, F.concat(F.lit("x"), n))
        .when(k % 5 == 3, F.lit(""))
        .otherwise(F.concat(k.cast("string"), F.lit("0000000000")))
    )


def text_to_int_q(spark, sf_dir):
    df = T(spark, sf_dir, "customer").select("c_custkey", _mixed_number_text().alias("raw_text"))
    return df.withColumn("as_int", text_to_int("raw_text"))


def numeric_day_to_date_q(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(dt.EPOCH))
    df = o.select("o_orderkey", F.concat(day.cast("string"), F.lit(".0")).alias("day_text"))
    return df.withColumn("arrival_date", day_number_to_date("day_text"))


def recode_case_q(spark, sf_dir):
    """Text keys, and numeric keys over text codes (decimal text, bad text and empty text are kept)."""
    o, k = T(spark, sf_dir, "orders"), F.col("o_custkey")
    code = F.when(k % 11 == 0, F.lit("x")).when(k % 11 == 1, F.lit("")).otherwise(
        F.concat((k % 11).cast("string"), F.lit(".0")))
    return o.select(
        "o_orderkey", recode("o_orderstatus", {"F": "finished", "O": "open"}).alias("status_label"),
        recode(code, MODE_RECODE).alias("mode_label"), recode(code, VISA_RECODE).alias("visa_label"))


def normalise_label_q(spark, sf_dir):
    n = T(spark, sf_dir, "nation")
    raw = F.concat(F.lit("\u00a0"), F.col("n_name"), F.lit(" \u00a0 "))
    return n.select("n_nationkey", normalise_text(raw).alias("label"))


def upper_case_q(spark, sf_dir):
    return T(spark, sf_dir, "part").select("p_partkey", upper_case("p_name").alias("name_upper"))


def substring_from_q(spark, sf_dir):
    return T(spark, sf_dir, "part").select("p_partkey", substring_from("p_brand", 7, 10).alias("brand_number"))


def parse_date_pattern_q(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.select("o_orderkey", parse_date(F.date_format("o_orderdate", "MM/dd/yyyy"), "MM/dd/yyyy").alias("order_date"))


# --- star links (J6-J8) ----------------------------------------------------------

def _orders_by_state(spark, sf_dir) -> DataFrame:
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def _order_counts_by_state(spark, sf_dir) -> DataFrame:
    """Orders reduced to one count per customer before the customer join
    (a hot customer crosses the join as one partial row)."""
    per_customer = T(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return per_customer.join(c, per_customer.o_custkey == c.c_custkey, "left")


def star_by_state(spark, sf_dir):
    s = T(spark, sf_dir, "supplier")
    dim = to_link_grain(s, "s_nationkey", {
        "n_suppliers": F.count(F.lit(1)),
        "supplier_acctbal": F.round(F.sum("s_acctbal"), 2),
    })
    df = star_link(_order_counts_by_state(spark, sf_dir), "c_nationkey", dim)
    return df.groupBy(F.col("c_nationkey").alias("state"), "n_suppliers", "supplier_acctbal").agg(
        F.sum("n").alias("n_arrivals")
    )


def star_by_state_count(spark, sf_dir):
    dim = count_per_key(T(spark, sf_dir, "supplier"), "s_nationkey", out="n_airports")
    df = star_link(_orders_by_state(spark, sf_dir), "c_nationkey", dim)
    return df.select("o_orderkey", F.col("c_nationkey").alias("state"), "n_airports")


def star_by_country(spark, sf_dir):
    n = T(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    book = n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    temp = group_avg_first(decode(c, "c_nationkey", book, "country"), "country", "c_acctbal", ["c_custkey"],
                           out_group="country", out_value="temperature").drop("c_custkey")
    fact = decode(_order_counts_by_state(spark, sf_dir), "c_nationkey", book, "country")
    fact = fact.withColumn("residence_country", F.lower("country"))
    df = star_link(fact, "residence_country", temp, "country", normalise="upper")
    return df.groupBy("residence_country", F.round("temperature", 4).alias("temperature")).agg(
        F.sum("n").alias("n_arrivals")
    )


def _star_tables(spark, sf_dir, decode_state):
    """The four builds over inputs whose states and countries meet."""
    lookups = Lookups(country=dt.country_lookup(spark, sf_dir), state=dt.state_lookup(spark, sf_dir))
    return (
        build_arrivals(dt.raw_arrivals(spark, sf_dir), lookups, decode_state=decode_state),
        build_demographics(dt.star_demographics(spark, sf_dir)),
        build_airports(dt.star_airports(spark, sf_dir)),
        build_temperature(dt.raw_temperature(spark, sf_dir)),
    )


def _enriched(spark, sf_dir, by):
    return enriched_arrivals(*_star_tables(spark, sf_dir, decode_state=by == "name"), by=by)


def star_enriched(spark, sf_dir):
    """J6-J8 on the published contracts, linked by state code and by full state name; one row per fact row and way."""
    shown = ["ID", "arrival_state", "Total_population", "n_cities", "n_airports",
             F.round("residence_temperature", 4).alias("residence_temperature")]
    return reduce(DataFrame.unionByName, [
        _enriched(spark, sf_dir, by).select(F.lit(by).alias("linked_by"), *shown) for by in ("code", "name")])


def star_state_month(spark, sf_dir):
    return arrivals_by_state_month(_enriched(spark, sf_dir, "code"))


# --- quality (Q1-Q4) -------------------------------------------------------------

def quality_non_empty(spark, sf_dir):
    tables = {t: T(spark, sf_dir, t) for t in TABLES}
    tables["region_atlantis"] = T(spark, sf_dir, "region").where(F.col("r_name") == "ATLANTIS")
    return non_empty_report(tables)


def quality_duplicate_keys(spark, sf_dir):
    return duplicate_keys(T(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def quality_key_summary(spark, sf_dir):
    return key_summary(T(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def quality_unmatched_codes(spark, sf_dir):
    return unmatched_codes(_decoded_documents(spark, sf_dir), [("doc_id", "quality"), ("doc_id", "toxic")])


def quality_unmatched_code_list(spark, sf_dir):
    return unmatched_code_list(_decoded_events(spark, sf_dir), "event_type", "event_label")


def schema_report_q(spark, sf_dir):
    src = T(spark, sf_dir, "customer")
    raw = src.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )
    return schema_report(raw, src.schema)


# --- builds (T1-T5) --------------------------------------------------------------

def _lookups(spark, sf_dir) -> Lookups:
    return Lookups(country=dt.country_lookup(spark, sf_dir))


def build_fact(spark, sf_dir):
    return build_arrivals(dt.raw_arrivals(spark, sf_dir), _lookups(spark, sf_dir))


def build_dimension_state(spark, sf_dir):
    return build_demographics(dt.raw_demographics(spark, sf_dir))


def build_dimension_country(spark, sf_dir):
    df = build_temperature(dt.raw_temperature(spark, sf_dir))
    return df.withColumn("Temperature", F.round("Temperature", 4))


def build_dimension_filtered(spark, sf_dir):
    return build_airports(dt.raw_airports(spark, sf_dir))


def _marked_lookups(spark, sf_dir) -> Lookups:
    """Every code book, with labels of every invalid class."""
    return Lookups(country=dt.marked_country_lookup(spark, sf_dir), port=dt.port_lookup(spark),
                   state=dt.state_lookup(spark, sf_dir))


def quality_fact_decodes(spark, sf_dir):
    return arrivals_decode_report(dt.raw_arrivals(spark, sf_dir), _marked_lookups(spark, sf_dir))


def quality_contract_keys(spark, sf_dir):
    tables = {
        "immigration": build_fact(spark, sf_dir),
        "demographics": build_dimension_state(spark, sf_dir),
        "temperature": build_temperature(dt.raw_temperature(spark, sf_dir)),
        "airports": build_dimension_filtered(spark, sf_dir),
    }
    return contract_key_report(tables, {name: CONTRACTS[name].key for name in tables})


def stream_monthly_drops(spark, sf_dir):
    """The incremental loader over whole tables: the raw arrivals rows are
    dropped as CSV files, the file stream loads every new file and refreshes
    the months they contain; the result is the fact table as stored."""
    drops = scratch_path(spark, "drops")
    dt.raw_arrivals(spark, sf_dir).write.option("header", "true").csv(drops)
    target = scratch_path(spark, "drops_fact")
    load_new_drops(spark, drops, _lookups(spark, sf_dir), target)
    return read_parquet(spark, target)


def _published_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "immigration": build_arrivals(dt.raw_arrivals(spark, sf_dir), _marked_lookups(spark, sf_dir), flags=True),
        "demographics": build_dimension_state(spark, sf_dir),
        "temperature": build_temperature(dt.raw_temperature(spark, sf_dir)),
        "airports": build_dimension_filtered(spark, sf_dir),
    }


def publish_report(spark, sf_dir):
    """All four tables staged, checked and released: rows, keys, rejects and codes."""
    return publish(spark, _published_tables(spark, sf_dir), scratch_path(spark, "publish"))


def publish_loads(spark, sf_dir):
    """Three loads into one warehouse: the odd months with rows without a month, a correction of them without any
    under the same name, and the even months with some; then a load without rows, which must change nothing.

    One row per applied load (what the ledger says) and, from the stored tables, its rejects and all fact rows.
    """
    root = scratch_path(spark, "publish-loads")
    tables = _published_tables(spark, sf_dir)
    fact = tables["immigration"].where("ID IS NOT NULL")
    lose = lambda df, n: df.withColumn("month", F.when(F.col("ID") % n != 0, F.col("month")))
    odd, even = fact.where("month % 2 = 1"), fact.where("month % 2 = 0")
    for load, df in (("odd", lose(odd, 50)), ("even", lose(even, 40)), ("odd", odd)):
        publish(spark, tables | {"immigration": df}, root, load=load)
    try:
        publish(spark, tables | {"immigration": fact.where("ID < 0")}, root, load="nothing")
    except ValueError:
        pass  # refused: the tables stay
    rejects = read_rejects(spark, f"{root}/immigration", CONTRACTS["immigration"].schema).groupBy("load").agg(
        F.count(F.lit(1)).alias("n_stored_rejects"))
    n_fact_rows = read_published(spark, root, "immigration").count()
    return applied_loads(spark, root).join(rejects, "load", "left").select(
        "load", F.size("months").alias("n_months"), "n_rows", "n_rejected",
        F.coalesce("n_stored_rejects", F.lit(0)).alias("n_stored_rejects"), F.lit(n_fact_rows).cast("long").alias("n_fact_rows"))


def quality_keys_across_months(spark, sf_dir):
    """Q2 over the months of a warehouse: odd and even months are published one after the other, and every tenth
    arrival of a month comes again in the month after; the index names the keys that two months hold."""
    root = scratch_path(spark, "publish-keys")
    tables = _published_tables(spark, sf_dir)
    fact = tables["immigration"]
    late = fact.where("ID % 10 = 0 AND month < 12").withColumn("month", F.col("month") + 1)
    twice = fact.unionByName(late)
    for parity in (1, 0):
        publish(spark, {"immigration": twice.where(F.col("month") % 2 == parity)}, root)
    return published_keys_across_months(spark, root).withColumnRenamed("key", "ID")


def load_tables_checked(spark, sf_dir):
    """The four tables published, loaded twice into catalog tables (the second load appends), and checked by name."""
    root = scratch_path(spark, "publish-load")
    publish(spark, _published_tables(spark, sf_dir), root)
    database = unique_table_name("warehouse")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    load_tables(spark, root, database=database)
    report = load_tables(spark, root, database=database).select(
        F.substring_index("table_name", ".", -1).alias("table_name"), "row_count", "passed")
    report = staged(report, "load-report")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return report


def star_state_month_refreshed(spark, sf_dir):
    """J6/J7 from per-month partial counts: the odd months are published with rows of other states, then the even
    months, then the odd months corrected; the report reads the months' states, not the fact."""
    fact, demographics, airports, _ = _star_tables(spark, sf_dir, decode_state=False)
    root = scratch_path(spark, "publish-star")
    odd, even = F.col("month") % 2 == 1, F.col("month") % 2 == 0
    for df in (fact.where(odd).withColumn("arrival_state", F.lit("S99")), fact.where(even), fact.where(odd)):
        publish(spark, {"immigration": df}, root, states=True)
    return published_state_month(spark, root, demographics, airports)


def profile_merged(spark, sf_dir):
    """A4/Q3 over all months of a fact whose months were loaded one after the other: merged from stored states."""
    fact = build_fact(spark, sf_dir)
    root = scratch_path(spark, "publish-profile")
    for parity in (0, 1):
        publish(spark, {"immigration": fact.where(F.col("month") % 2 == parity)}, root, states=True)
    return published_profile(spark, root).drop("n_distinct")


def group_avg_merged(spark, sf_dir):
    """A1 from the states of three drops of unequal size, each stored on its own."""
    c = T(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 10
    paths = []
    for drop in (k < 1, (k >= 1) & (k < 4), k >= 4):
        state = mean_states(c.where(drop), "c_mktsegment", "c_acctbal", ["c_name", "c_custkey"], out_group="segment")
        paths.append(scratch_path(spark, "mean-state"))
        write_parquet(state, paths[-1])
    return means(read_parquet(spark, paths), "segment", "avg_acctbal")


def decode_hot_codes(spark, sf_dir):
    """J1 with a book beyond the broadcast bound and a third of the rows on one code."""
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).cast("string").alias("l_partkey"))
    return decode_hybrid(li, "l_partkey", T(spark, sf_dir, "part"), ["brand", "size"], lookup_code="p_partkey",
                         lookup_label=["p_brand", "p_size"], keep_code=True, max_broadcast_rows=100)


QUERIES: dict[str, Query] = {
    "arrivals_by_nation_month": arrivals_by_nation_month,
    "scan_csv_header": scan_csv_header,
    "scan_csv_mixed_headers": scan_csv_mixed_headers,
    "scan_csv_rejects": scan_csv_rejects,
    "scan_csv_semicolon": scan_csv_semicolon,
    "scan_by_format": scan_by_format,
    "scan_csv_inferred": scan_csv_inferred,
    "scan_lookup_quoted": scan_lookup_quoted,
    "scan_parquet": scan_parquet,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "load_append_by_name": load_append_by_name,
    "conform_schema": conform_schema,
    "table_replace": table_replace,
    "refresh_month": refresh_month,
    "rename_columns": rename_columns_q,
    "drop_columns": drop_columns_q,
    "select_columns": select_columns_q,
    "preview_rows": preview_rows,
    "drop_null_single": drop_null_single,
    "drop_null_any": drop_null_any,
    "filter_equals": filter_equals_q,
    "decode_left": decode_left,
    "decode_int_text": decode_int_text,
    "decode_string_key": decode_string_key,
    "decode_with_default": decode_with_default,
    "decode_role_playing": decode_role_playing,
    "group_avg_first": group_avg_first_q,
    "row_count": row_count_q,
    "null_profile": null_profile_q,
    "aggregate_by_state": aggregate_by_state_q,
    "aggregate_race_by_state": aggregate_race_by_state_q,
    "text_to_int": text_to_int_q,
    "numeric_day_to_date": numeric_day_to_date_q,
    "recode_case": recode_case_q,
    "normalise_label": normalise_label_q,
    "upper_case": upper_case_q,
    "substring_from": substring_from_q,
    "parse_date_pattern": parse_date_pattern_q,
    "star_by_state": star_by_state,
    "star_by_state_count": star_by_state_count,
    "star_by_country": star_by_country,
    "star_enriched": star_enriched,
    "star_state_month": star_state_month,
    "quality_non_empty": quality_non_empty,
    "quality_duplicate_keys": quality_duplicate_keys,
    "quality_key_summary": quality_key_summary,
    "quality_unmatched_codes": quality_unmatched_codes,
    "quality_unmatched_code_list": quality_unmatched_code_list,
    "schema_report": schema_report_q,
    "quality_contract_keys": quality_contract_keys,
    "quality_fact_decodes": quality_fact_decodes,
    "build_fact": build_fact,
    "build_dimension_state": build_dimension_state,
    "build_dimension_country": build_dimension_country,
    "build_dimension_filtered": build_dimension_filtered,
    "publish_report": publish_report,
    "publish_loads": publish_loads,
    "load_tables_checked": load_tables_checked,
    "star_state_month_refreshed": star_state_month_refreshed,
    "profile_merged": profile_merged,
    "group_avg_merged": group_avg_merged,
    "decode_hot_codes": decode_hot_codes,
    "quality_keys_across_months": quality_keys_across_months,
    "stream_monthly_drops": stream_monthly_drops,
}

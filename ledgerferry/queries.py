"""The library's operators applied to the driver tables, with the SQL that says the same.

Adapters only rename and encode columns: a table becomes change records (type-tagged JSON
in an envelope), ledger rows or response bodies, and the library does the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerferry.config import MigrationConfig
from ledgerferry.functions.jsontext import lit
from ledgerferry.functions.responses import (
    TOTAL_FIELDS,
    allow_repeated_keys,
    bulk_results,
    bulk_total,
    parse_bodies,
    single_outcome,
    with_new_id,
)
from ledgerferry.functions.scalars import (
    integral,
    to_boolean,
    to_epoch_seconds,
    to_integer,
    to_string_array,
)
from ledgerferry.functions.tagged import attr, has, record_json
from ledgerferry.operators.decode import accepted, decode, decode_deep
from ledgerferry.operators.deliver import deliver
from ledgerferry.operators.latest import latest
from ledgerferry.operators.lookup import attach_parent, chain_levels, lookup, require
from ledgerferry.operators.merge import merge_final, merge_running, merged_roles
from ledgerferry.operators.once import once
from ledgerferry.operators.routing import route
from ledgerferry.plans.children import (
    bulk_children,
    document_children,
    expand,
    manager_requests,
)
from ledgerferry.plans.entities import FMS, KEY_ATTRIBUTES, SPECS, build_requests
from ledgerferry.plans.flow import run_batch
from ledgerferry.plans.outcomes import ledger_rows, settle, unresolved
from ledgerferry.sources.changes import stream_json
from ledgerferry.sources.ledger import LedgerStore, outcome_count
from ledgerferry.sources.storage import cut, new_scratch_path
from ledgerferry.streaming.contacts import start_contacts
from ledgerferry.streaming.driver import start_migration

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = MigrationConfig(renames={"teamCode": "team_id"})
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan over at least as many tasks as there are cores.

    A table of one small file is read by one task, which would then do all the decoding.
    Tables of many files are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


# --- adapters ---------------------------------------------------------------------------


def s(expression: str) -> str:
    """Text value in tagged form."""
    return f"named_struct('S', CAST({expression} AS STRING))"


def n(expression: str) -> str:
    """Number in tagged form."""
    return f"named_struct('N', CAST({expression} AS STRING))"


def b(expression: str) -> str:
    """Boolean in tagged form."""
    return f"named_struct('BOOL', {expression})"


def m(**fields: str) -> str:
    """Nested map in tagged form."""
    inner = ", ".join(f"{lit(k)}, {v}" for k, v in fields.items())
    return f"named_struct('M', named_struct({inner}))"


def many(*items: str) -> str:
    """List in tagged form; the items must have one shape."""
    return f"named_struct('L', array({', '.join(items)}))"


def image(pk: str, sk: str, **attributes: str) -> str:
    """Row image as JSON text."""
    fields = {"pk": s(lit(pk)), "sk": sk, **attributes}
    inner = ", ".join(f"{lit(k)}, {v}" for k, v in fields.items())
    return f"to_json(named_struct({inner}))"


def changes(rows: DataFrame, seq: str, new_image: str) -> DataFrame:
    return spread(rows).selectExpr(
        f"CAST({seq} AS BIGINT) AS seq",
        "'INSERT' AS eventName",
        f"named_struct('NewImage', {new_image}) AS dynamodb",
    )


def records(rows: DataFrame, seq: str, new_image: str) -> DataFrame:
    """Decoded records of a table."""
    return accepted(decode(changes(rows, seq, new_image)))


def ledger_of(rows: DataFrame, pk: str, key: str, success: str) -> DataFrame:
    """Ledger rows of a table's keys: `success` decides the result."""
    return rows.selectExpr(
        f"{lit(pk)} AS pk",
        f"concat(if({success}, 'success#', 'failed#'), {key}) AS sk",
        f"if({success}, 'success', 'failed') AS result",
        f"if({success}, concat('v2-', {key}), NULL) AS v2_value",
        "CAST(0 AS BIGINT) AS seq",
        "CAST(0 AS BIGINT) AS batch_id",
    )


def read_payload(requests: DataFrame, schema: str, *columns: str) -> DataFrame:
    """Requests with their JSON payload read back as columns of `p`."""
    return once(requests, p=f"from_json(payload, {lit(schema)})").selectExpr(*columns)


def read_app_request(requests: DataFrame, schema: str, *columns: str) -> DataFrame:
    """The same for payloads that carry the body as embedded text."""
    body = f"from_json(get_json_object(payload, '$.api_request'), {lit(schema)})"
    return once(requests, p=body).selectExpr(*columns)


# --- decoding and routing ---------------------------------------------------------------


@query(
    """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
           round(c_acctbal, 2) AS c_acctbal, c_mktsegment, c_mktsegment AS nested_segment,
           round(c_acctbal, 2) AS nested_balance, true AS has_empty_map
    FROM customer
    """
)
def decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "customer"),
        "c_custkey",
        image(
            "organization",
            n("c_custkey"),
            name=s("c_name"),
            nation=n("c_nationkey"),
            balance=n("c_acctbal"),
            profile=m(
                segment=s("c_mktsegment"),
                history=many(m(balance=n("c_acctbal"))),
                empty="named_struct('M', map())",
            ),
        ),
    )
    profile = f"{attr('profile')}.text"
    return decoded.selectExpr(
        "CAST(sk AS BIGINT) AS c_custkey",
        f"{attr('name')}.text AS c_name",
        f"CAST({attr('nation')}.text AS BIGINT) AS c_nationkey",
        f"round(CAST({attr('balance')}.text AS DOUBLE), 2) AS c_acctbal",
        f"get_json_object({profile}, '$.segment') AS c_mktsegment",
        f"get_json_object({profile}, '$.segment') AS nested_segment",
        f"round(CAST(get_json_object({profile}, '$.history[0].balance') AS DOUBLE), 2)"
        " AS nested_balance",
        f"get_json_object({profile}, '$.empty') = '{{}}' AS has_empty_map",
    )


@query(
    """
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE event_type END AS event_type,
           true AS is_present, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS nested
    FROM events
    """
)
def null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "CASE event_type WHEN 'error' THEN 'NULL' WHEN 'view' THEN '' ELSE event_type END"
    inner = "CASE event_type WHEN 'view' THEN '' ELSE event_type END"
    decoded = records(
        table(spark, sf_dir, "events"),
        "event_id",
        image("deal_note", n("event_id"), kind=s(kind), inner=m(kind=s(inner))),
    )
    return decoded.selectExpr(
        "seq AS event_id",
        f"{attr('kind')}.text AS event_type",
        f"{has('kind')} AS is_present",
        f"get_json_object({attr('inner')}.text, '$.kind') AS nested",
    )


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'undecodable' WHEN 'click' THEN 'bad_attribute'
                           ELSE 'accepted' END AS outcome
    FROM events WHERE event_type <> 'signup'
    """
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are cut off, clicks carry a bad number, signups have no new image."""
    whole = image("deal_note", n("event_id"), props=s("props"))
    bad = image("deal_note", n("event_id"), props=n("props"))
    raw = (
        f"CASE event_type WHEN 'error' THEN left({whole}, length({whole}) - 3)"
        f" WHEN 'click' THEN {bad} WHEN 'signup' THEN NULL ELSE {whole} END"
    )
    decoded = decode(changes(table(spark, sf_dir, "events"), "event_id", raw))
    return decoded.selectExpr("seq AS event_id", "coalesce(reject_reason, 'accepted') AS outcome")


ROUTED_AS = (
    "CASE event_type WHEN 'click' THEN 'contact_task' WHEN 'error' THEN 'deal_task'"
    " WHEN 'purchase' THEN 'deal' WHEN 'view' THEN 'contact_note' ELSE event_type END"
)


@query(
    f"""
    SELECT CASE WHEN pk = 'signup' THEN 'unrouted' ELSE pk END AS route, count(*) AS n
    FROM (SELECT {ROUTED_AS} AS pk FROM events) GROUP BY 1
    """
)
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new_image = (
        f"to_json(named_struct('pk', {s(ROUTED_AS)}, 'sk', {n('event_id')}))"
    )
    decoded = decode(changes(table(spark, sf_dir, "events"), "event_id", new_image))
    return route(decoded).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


# --- scalar functions -------------------------------------------------------------------


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS flag,
           CASE WHEN l_linestatus = 'O' THEN true ELSE false END AS status
    FROM lineitem
    """
)
def scalar_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = "CASE l_returnflag WHEN 'A' THEN ' Yes ' WHEN 'R' THEN 'never' ELSE '  ' END"
    status = "CASE l_linestatus WHEN 'O' THEN 'T' ELSE '0' END"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{to_boolean(f'({flag})')} AS flag",
        f"{to_boolean(f'({status})')} AS status",
    )


@query(
    """
    SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS from_datetime,
           CAST(epoch(o_orderdate) AS BIGINT) AS from_date, CAST(NULL AS BIGINT) AS from_offset
    FROM orders
    """
)
def scalar_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "CAST(o_orderdate AS STRING)"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"{to_epoch_seconds(f'concat({text}, \"Z\")')} AS from_datetime",
        f"{to_epoch_seconds(f'substring({text}, 1, 10)')} AS from_date",
        f"{to_epoch_seconds(f'concat({text}, \"+05:00\")')} AS from_offset",
    )


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def scalar_epoch_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "replace(CAST(ts AS STRING), ' ', 'T')"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{to_epoch_seconds(text)} AS seconds"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_orderkey || '|' || l_partkey AS ids,
           CAST(2 AS BIGINT) AS n_ids
    FROM lineitem
    """
)
def scalar_string_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = to_string_array("concat('[', l_orderkey, ', ', l_partkey, ' ,]')")
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"array_join({ids}, '|') AS ids",
        f"CAST(size({ids}) AS BIGINT) AS n_ids",
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS BIGINT) AS price,
           CAST(-trunc(l_extendedprice) AS BIGINT) AS negative, CAST(l_partkey AS BIGINT) AS key,
           CASE WHEN l_extendedprice = trunc(l_extendedprice) AND false
                THEN CAST(0 AS BIGINT) END AS fractional_text,
           CASE WHEN l_returnflag = 'N' THEN CAST(0 AS BIGINT)
                ELSE CAST(trunc(l_quantity) AS BIGINT) END AS quantity_or_zero
    FROM lineitem
    """
)
def scalar_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number(text: str) -> str:
        return f"named_struct('tag', 'N', 'text', CAST({text} AS STRING))"

    quantity = "if(l_returnflag = 'N', NULL, CAST(l_quantity AS STRING))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{to_integer(number('l_extendedprice'))} AS price",
        f"{to_integer(number('-l_extendedprice'))} AS negative",
        f"{integral('concat(\" \", l_partkey)')} AS key",
        f"{integral('CAST(l_extendedprice AS STRING)')} AS fractional_text",
        f"coalesce({to_integer(number(quantity))}, 0) AS quantity_or_zero",
    )


@query(
    """
    SELECT s_suppkey, s_name, CAST(s_nationkey AS DOUBLE) AS nation_id,
           round(s_acctbal, 2) AS s_acctbal, false AS has_old_name, false AS has_keys
    FROM supplier
    """
)
def payload_filter_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        image(
            "organization",
            n("s_suppkey"),
            s_nationkey=n("s_nationkey"),
            s_name=s("s_name"),
            s_acctbal=n("s_acctbal"),
        ),
    )
    payload = record_json(KEY_ATTRIBUTES, rename={"s_nationkey": "nation_id"})
    return once(decoded, payload=payload).selectExpr("seq AS s_suppkey", "payload").selectExpr(
        "s_suppkey",
        "get_json_object(payload, '$.s_name') AS s_name",
        "CAST(get_json_object(payload, '$.nation_id') AS DOUBLE) AS nation_id",
        "round(CAST(get_json_object(payload, '$.s_acctbal') AS DOUBLE), 2) AS s_acctbal",
        "array_contains(json_object_keys(payload), 's_nationkey') AS has_old_name",
        "arrays_overlap(json_object_keys(payload), array('pk', 'sk', 'id')) AS has_keys",
    )


# --- lookups ----------------------------------------------------------------------------


@query(
    """
    SELECT o_orderkey, CASE WHEN c_acctbal >= 0 THEN 'v2-' || c_custkey END AS organization_v2,
           CASE WHEN c_acctbal >= 0 THEN NULL
                ELSE 'v2_not_found:organization:' || o_custkey END AS failure
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """
)
def lookup_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = ledger_of(
        table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0"
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_custkey AS STRING) AS customer"
    )
    found = lookup(orders, ledger, organization_v2=("organization", "customer"))
    return require(found, "organization", "customer", "organization_v2").drop("customer")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN p_size > 5 THEN 'v2-' || l_partkey END AS part_v2,
           CASE WHEN s_acctbal >= 0 THEN 'v2-' || l_suppkey END AS supplier_v2,
           CASE WHEN p_size > 5 THEN NULL
                ELSE 'v2_not_found:organization:' || l_partkey END AS failure
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
                  LEFT JOIN supplier ON l_suppkey = s_suppkey
    """
)
def lookup_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = ledger_of(
        table(spark, sf_dir, "part"), "organization", "p_partkey", "p_size > 5"
    ).unionByName(
        ledger_of(table(spark, sf_dir, "supplier"), "user_group", "s_suppkey", "s_acctbal >= 0")
    )
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CAST(l_partkey AS STRING) AS part",
        "CAST(l_suppkey AS STRING) AS supplier",
    )
    found = lookup(
        items, ledger, part_v2=("organization", "part"), supplier_v2=("user_group", "supplier")
    )
    return require(found, "organization", "part", "part_v2").drop("part", "supplier")


@query(
    """
    WITH RECURSIVE chain AS (
        SELECT c_custkey, CAST(0 AS BIGINT) AS level FROM customer WHERE c_custkey = 0
        UNION ALL
        SELECT c.c_custkey, chain.level + 1 FROM customer c
        JOIN chain ON c.c_custkey // 10 = chain.c_custkey AND c.c_custkey <> 0)
    SELECT c_custkey, level FROM chain
    """
)
def lookup_self_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "if(c_custkey = 0, NULL, c_custkey DIV 10) AS lead"
    )
    return chain_levels(customers, "c_custkey", "lead").select("c_custkey", "level")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN o_orderstatus <> 'P' THEN 'v2-' || o_orderkey END AS parent_v2
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def parent_id_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey",
        "if(o_orderstatus <> 'P', concat('v2-', o_orderkey), NULL) AS parent_v2",
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return attach_parent(items, parents, ["l_orderkey"])


@query(
    """
    SELECT event_id, event_id % 8 + 1 AS depth,
           CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'q' WHEN 2 THEN 'x' END AS leaf_text,
           CASE WHEN event_id % 4 = 0 THEN round(value, 4) END AS leaf_number,
           CASE WHEN event_id % 4 = 3 THEN 'bad_attribute' END AS reject_reason
    FROM events
    """
)
def decode_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to eight levels around a number that is no text, two tags, a text, or no number at all:
    the same reading at every depth."""
    leaf = (
        "CASE event_id % 4 WHEN 0 THEN concat('{\"N\":', value, '}')"
        " WHEN 1 THEN '{\"N\":\"5\",\"S\":\"q\"}' WHEN 2 THEN '{\"S\":\"x\"}' ELSE '{\"N\":\"x\"}' END"
    )
    depth = "CAST(event_id % 8 + 1 AS INT)"
    deep = f"concat(repeat('{{\"M\":{{\"k\":', {depth}), {leaf}, repeat('}}}}', {depth}))"
    raw = f"concat('{{\"pk\":{{\"S\":\"deal\"}},\"v\":', {deep}, '}}')"
    decoded = decode(changes(table(spark, sf_dir, "events"), "event_id", raw))
    shallow = decoded.filter("NOT reject_reason <=> 'too_deep'")
    text = f"{attr('v')}.text"
    return shallow.unionByName(decode_deep(decoded)).selectExpr(
        "seq AS event_id",
        f"if(attrs IS NULL, seq % 8 + 1, (length({text}) - length(replace({text}, '\"k\"', ''))) DIV 3) AS depth",
        f"nullif(regexp_extract({text}, '\"([qx])\"', 1), '') AS leaf_text",
        f"round(CAST(nullif(regexp_extract({text}, ':([-0-9.E]+)', 1), '') AS DOUBLE), 4) AS leaf_number",
        "reject_reason",
    )


# --- fan-out ----------------------------------------------------------------------------


def answer_log(rows: DataFrame, pk: str, key: str, body: str) -> DataFrame:
    """Delivered single requests whose response body is an expression over a table."""
    return rows.selectExpr(
        f"{lit(pk)} AS pk",
        f"CAST({key} AS STRING) AS sk",
        f"CAST({key} AS STRING) AS base_key",
        f"CAST({key} AS BIGINT) AS seq",
        f"{lit(pk)} AS step",
        "'' AS pos",
        "false AS bulk",
        "'{}' AS payload",
        "CAST(NULL AS STRING) AS failure",
        "CAST(NULL AS STRING) AS reject_reason",
        "200 AS status",
        f"{body} AS body",
        "1 AS attempts",
        "CAST(NULL AS STRING) AS transport_error",
    )


@query(
    """
    SELECT o_orderkey || '#bdm' AS base_key, CAST(2 AS BIGINT) AS n_managers,
           CASE WHEN o_orderstatus <> 'P' THEN 'L' || o_orderkey END AS lender_id,
           o_orderpriority AS email, o_orderstatus AS title,
           CASE WHEN o_orderstatus = 'P' THEN 'parent_failed:lender:' || o_orderkey END AS failure
    FROM orders
    """
)
def parent_id_to_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lenders = records(
        orders,
        "o_orderkey",
        image(
            "lender",
            n("o_orderkey"),
            lender_business_development_manager=many(
                m(email_address=s("o_orderpriority"), title=s("'first'")),
                m(email_address=s("'other'"), title=s("o_orderstatus")),
            ),
        ),
    )
    body = (
        "if(o_orderstatus = 'P', '{\"status\":\"down\"}', to_json(named_struct('status', 'ok',"
        " 'data', named_struct('loan_lender_application_id', concat('L', o_orderkey)))))"
    )
    responses = settle(answer_log(orders, "lender", "o_orderkey", body)).select(
        "sk", "seq", "is_success", "response"
    )
    item = "record_create_list array<struct<lender_id:string,email_address:string,title:string>>"
    return read_app_request(
        manager_requests(lenders, responses, CONFIG),
        item,
        "base_key",
        "CAST(size(p.record_create_list) AS BIGINT) AS n_managers",
        "p.record_create_list[0].lender_id AS lender_id",
        "p.record_create_list[0].email_address AS email",
        "p.record_create_list[1].title AS title",
        "failure",
    )


def order_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deals; open ones have a second document map, others no participants."""
    document = m(
        document_name=s("o_orderpriority"),
        document_format=s("'pdf'"),
        document_path=s("concat(o_custkey, '/', o_orderkey)"),
    )
    full = m(
        deal_id=s("o_orderkey"),
        loan_document_map=m(status=s("o_orderstatus")),
        docs=many(document, document),
    )
    return records(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image(
            "deal",
            n("o_orderkey"),
            price=n("o_totalprice"),
            documents=f"if(o_orderstatus = 'O', {many(full, full)}, {many(full)})",
            fees=many(
                m(fee_id=s("o_orderkey"), amount=n("o_totalprice"), description=s("'fee'")),
                m(fee_id=s("o_custkey"), amount=n("1"), description=s("o_orderstatus")),
            ),
            participants=f"if(o_orderstatus = 'O',"
            f" {many(m(participant_id=s('o_custkey'), name=s('o_orderpriority'), role=s('o_orderstatus')))},"
            " NULL)",
            sign_submission_status=many(
                m(submission_id=s("o_orderkey"), status=s("o_orderstatus"), timestamp=s("'t1'"))
            ),
            credit_consent=many(
                m(consent_id=s("o_custkey"), consent_status=s("o_orderstatus"), timestamp=s("'t2'"))
            ),
            credit_pull=many(
                m(pull_id=s("o_orderkey"), credit_score=n("o_custkey"), timestamp=s("'t3'"))
            ),
            refrence_mapping=many(
                m(mapping_id=s("o_orderkey"), source=s("o_orderstatus"), target=s("o_orderpriority"))
            ),
        ),
    )


@query(
    """
    WITH maps AS (
        SELECT *, unnest(CASE WHEN o_orderstatus = 'O' THEN [0, 1] ELSE [0] END) AS map_pos
        FROM orders),
    docs AS (SELECT *, unnest([0, 1]) AS pos FROM maps)
    SELECT o_orderkey || '#document#' || map_pos AS base_key, CAST(o_orderkey AS VARCHAR) AS deal_id,
           o_orderstatus AS map_status, NULL AS name, NULL AS storage_path,
           CAST(NULL AS BIGINT) AS size
    FROM maps
    UNION ALL
    SELECT o_orderkey || '#document#docs#' || map_pos || '#' || pos, NULL, NULL, o_orderpriority,
           's3://documents/' || o_custkey || '/' || o_orderkey, 1024
    FROM docs
    """
)
def fanout_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_payload(
        expand(order_deals(spark, sf_dir), document_children(CONFIG)),
        "deal_id string, loan_document_map struct<status:string>, name string,"
        " storage_path string, size bigint",
        "base_key",
        "p.deal_id",
        "p.loan_document_map.status AS map_status",
        "p.name",
        "p.storage_path",
        "p.size",
    )


@query(
    """
    WITH lists AS (
        SELECT *, unnest(['fees', 'participants', 'sign_submission_status', 'credit_consent',
                          'credit_pull', 'refrence_mapping']) AS list FROM orders)
    SELECT o_orderkey || '#' || list AS base_key,
           CAST(CASE WHEN list = 'fees' THEN 2
                     WHEN list = 'participants' AND o_orderstatus <> 'O' THEN 0
                     ELSE 1 END AS BIGINT) AS n_items,
           CASE WHEN list = 'participants' AND o_orderstatus <> 'O' THEN NULL
                WHEN list IN ('participants', 'credit_consent') THEN CAST(o_custkey AS VARCHAR)
                ELSE CAST(o_orderkey AS VARCHAR) END AS id,
           CASE WHEN list = 'fees' THEN round(o_totalprice, 2)
                WHEN list = 'credit_pull' THEN CAST(o_custkey AS DOUBLE) END AS number,
           CASE list WHEN 'fees' THEN 'fee' WHEN 'sign_submission_status' THEN o_orderstatus || '|t1'
                WHEN 'credit_consent' THEN o_orderstatus || '|t2' WHEN 'credit_pull' THEN 't3'
                WHEN 'refrence_mapping' THEN o_orderstatus || '|' || o_orderpriority
                ELSE CASE WHEN o_orderstatus = 'O' THEN o_orderpriority || '|' || o_orderstatus
                          ELSE '' END END AS texts
    FROM lists
    """
)
def fanout_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First element of every list, all its fields."""
    ids = ("fee_id", "participant_id", "submission_id", "consent_id", "pull_id", "mapping_id")
    texts = ("description", "name", "role", "status", "consent_status", "source", "timestamp", "target")
    fields = ",".join(f"{name}:string" for name in (*ids, *texts))
    first = "get(p.record_create_list, 0)"
    return read_app_request(
        expand(order_deals(spark, sf_dir), bulk_children(CONFIG)),
        f"record_create_list array<struct<amount:double,credit_score:double,{fields}>>",
        "base_key",
        "CAST(size(p.record_create_list) AS BIGINT) AS n_items",
        f"coalesce({', '.join(f'{first}.{name}' for name in ids)}) AS id",
        f"round(coalesce({first}.amount, {first}.credit_score), 2) AS number",
        f"concat_ws('|', {', '.join(f'{first}.{name}' for name in texts)}) AS texts",
    )


@query(
    """
    SELECT o_orderkey || '#fees' AS base_key,
           CASE WHEN o_orderkey % 4 <> 3 THEN 'bad_list:fees' END AS reject_reason,
           CASE WHEN o_orderkey % 4 = 3 THEN 'g' END AS fee_id, o_orderkey % 4 = 3 AS keeps_point
    FROM orders
    """
)
def child_list_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees as a text, a map, and a list of texts are set aside; a repeated key's last value counts."""
    fees = (
        "CASE o_orderkey % 4 WHEN 0 THEN '{\"S\":\"none\"}' WHEN 1 THEN '{\"M\":{\"a\":{\"S\":\"b\"}}}'"
        " WHEN 2 THEN '{\"L\":[{\"S\":\"x\"}]}' ELSE '{\"L\":[{\"M\":{\"fee_id\":{\"S\":\"f\"},"
        "\"amount\":{\"N\":\"2\"},\"fee_id\":{\"S\":\"g\"}}}]}' END"
    )
    raw = f"""concat('{{"pk":{{"S":"deal"}},"sk":{{"N":"', o_orderkey, '"}},"fees":', {fees}, '}}')"""
    deals = records(table(spark, sf_dir, "orders"), "o_orderkey", raw)
    allow_repeated_keys(spark)
    sent = expand(deals, bulk_children(CONFIG)).filter("step = 'fees'")
    body = "get_json_object(payload, '$.api_request')"
    return sent.selectExpr(
        "base_key",
        "reject_reason",
        f"get_json_object({body}, '$.record_create_list[0].fee_id') AS fee_id",
        f"coalesce(contains({body}, '\"amount\":2.0,'), false) AS keeps_point",
    )


# --- delivery ---------------------------------------------------------------------------


def request_log(rows: DataFrame, pk: str, base_key: str, seq: str, **columns: str) -> DataFrame:
    """Rows of a table as requests."""
    given = {
        "pk": pk,
        "sk": f"CAST({base_key} AS STRING)",
        "base_key": f"CAST({base_key} AS STRING)",
        "seq": f"CAST({seq} AS BIGINT)",
        "step": pk,
        "pos": "''",
        "bulk": "false",
        "endpoint": "''",
        "headers": "CAST(map() AS map<string,string>)",
        "payload": "'{}'",
        "failure": "CAST(NULL AS STRING)",
        "reject_reason": "CAST(NULL AS STRING)",
        "n_items": "CAST(NULL AS INT)",
        **columns,
    }
    return rows.selectExpr(*[f"{v} AS {k}" for k, v in given.items()])


def open_remembering() -> Callable[[dict, int], tuple[int, str]]:
    """Answers with the order number it last saw for the record as the new id."""
    last: dict[str, int] = {}

    def send(request: dict, attempt: int) -> tuple[int, str]:
        before = f"after {last.get(request['base_key'], 'none')}"
        last[request["base_key"]] = request["seq"]
        return 200, json.dumps({"data": {"application_id": before}})

    return send


@query(
    """
    SELECT event_id, user_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
    FROM events
    """
)
def delivery_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of one record go out in their order."""
    requests = request_log(table(spark, sf_dir, "events"), "'deal_note'", "user_id", "event_id")
    log = settle(cut(deliver(requests, open_remembering)))
    return log.selectExpr(
        "seq AS event_id",
        "CAST(base_key AS BIGINT) AS user_id",
        "try_cast(substring(v2_value, 7) AS BIGINT) AS previous",
    )


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'no_id' WHEN 'error' THEN 'Invalid response format'
                WHEN 'purchase' THEN 'no_result' WHEN 'signup' THEN 'Failed to parse api response'
                ELSE 'connection reset' END AS reason,
           event_type IN ('signup', 'view') AS in_ledger
    FROM events
    UNION ALL
    SELECT event_id, CASE WHEN half = 0 THEN 'success' ELSE '{"statusCode":500}' END, true
    FROM (SELECT event_id, unnest([0, 1]) AS half FROM events WHERE event_type = 'purchase')
    """
)
def answers_unusual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks succeed without an id, errors and purchases are bulk answers that cannot be read or
    lack a result, signups wrap broken text, views end in an exception. A purchase sends three
    records and gets two results, of which the second one failed."""
    results = (
        '[{"statusCode":200,"data":{"application_id":"x"}},{"statusCode":500}]'
    )
    body = (
        "CASE event_type WHEN 'click' THEN '{\"status\":\"ok\"}' WHEN 'error' THEN '{\"ok\":1}'"
        f" WHEN 'purchase' THEN to_json(named_struct('api_response', '{{\"result\":{results}}}'))"
        " WHEN 'signup' THEN '{\"api_response\":\"{oops\"}' END"
    )
    log = request_log(
        table(spark, sf_dir, "events"),
        "event_type",
        "event_id",
        "event_id",
        bulk="event_type IN ('error', 'purchase')",
        n_items="if(event_type = 'purchase', 3, if(event_type = 'error', 1, NULL))",
        status="if(event_type = 'view', NULL, 200)",
        body=body,
        attempts="1",
        transport_error="if(event_type = 'view', 'connection reset', NULL)",
    )
    answered = cut(settle(log))
    kept = ledger_rows(answered, 0).selectExpr(
        "seq AS event_id",
        "if(result = 'success', 'success', coalesce(errorMsg, response)) AS reason",
        "true AS in_ledger",
    )
    # A failed result of a bulk answer is told twice, as message and as response.
    lost = unresolved(answered).selectExpr("seq AS event_id", "reason", "false AS in_ledger")
    return kept.unionByName(lost)


# --- contact merge ----------------------------------------------------------------------

ROLE_OF = (
    "CASE event_type WHEN 'purchase' THEN 'Client' WHEN 'signup' THEN 'businesspartner'"
    " WHEN 'click' THEN 'realtor' WHEN 'view' THEN 'appraiser' ELSE 'visitor' END"
)
# The same merge in SQL: rank of the record's role, best rank before it, and what it sets.
MERGE_SQL = """
    WITH ranked AS (
        SELECT event_id, user_id, value, props,
               CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 4
                               WHEN 'view' THEN 5 ELSE 6 END AS ix,
               CASE WHEN value >= 10 THEN value END AS amount,
               CASE WHEN event_type <> 'click' THEN props END AS note
        FROM events),
    prior AS (
        SELECT *, min(ix) OVER (PARTITION BY user_id ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_rank
        FROM ranked),
    marked AS (
        SELECT *, CASE WHEN amount IS NOT NULL OR prior_rank IS NULL OR ix >= prior_rank
                       THEN event_id END AS amount_at,
                  CASE WHEN note IS NOT NULL OR prior_rank IS NULL OR ix >= prior_rank
                       THEN event_id END AS note_at
        FROM prior),
    running AS (
        SELECT event_id, user_id, ix, prior_rank,
               arg_max_null(amount, amount_at) OVER w AS amount,
               arg_max_null(note, note_at) OVER w AS note,
               count(*) OVER w AS n_roles
        FROM marked
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
MERGED = {"amount": "amount IS NOT NULL AND amount <> 0", "note": "note <> ''"}


def contact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        f"array({ROLE_OF}) AS roles",
        "if(value >= 10, value, NULL) AS amount",
        "if(event_type <> 'click', props, NULL) AS note",
    )


@query(
    MERGE_SQL
    + """
    SELECT event_id, user_id, amount, note, CAST(prior_rank AS BIGINT) AS prior_rank, n_roles
    FROM running
    """
)
def contact_merge_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_running(
        contact_events(spark, sf_dir), "user_id", "event_id", "roles", MERGED
    )
    return merged.selectExpr(
        "event_id", "user_id", "amount", "note", "CAST(prior_rank AS BIGINT) AS prior_rank", "n_roles"
    )


@query(
    MERGE_SQL
    + """
    SELECT user_id, arg_max_null(amount, event_id) AS amount, arg_max_null(note, event_id) AS note,
           CAST(min(ix) AS BIGINT) AS best_rank, max(n_roles) AS n_roles, max(event_id) AS event_id
    FROM running GROUP BY user_id
    """
)
def contact_merge_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_final(contact_events(spark, sf_dir), "user_id", "event_id", "roles", MERGED)
    return merged.selectExpr(
        "user_id", "amount", "note", "CAST(best_rank AS BIGINT) AS best_rank", "n_roles", "event_id"
    )


@query(
    f"""
    SELECT user_id, {ROLE_OF} AS role,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS position
    FROM events
    """
)
def contact_merge_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_roles(contact_events(spark, sf_dir), "user_id", "event_id", "roles")


# --- responses --------------------------------------------------------------------------


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus
               WHEN 'O' THEN o_orderpriority <> '1-URGENT'
               WHEN 'F' THEN o_orderpriority <> '5-LOW'
               ELSE false END AS is_success,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' THEN 'A' || o_orderkey
                WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
                THEN CAST(o_orderkey + 1 AS VARCHAR) END AS v2_value
    FROM orders
    """
)
def response_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders answer in wrapped form, filled ones by status, the rest with an error."""
    code = "if(o_orderpriority = '1-URGENT', '500', '200')"
    wrapped = (
        f"to_json(named_struct('api_response', to_json(named_struct('statusCode', {code},"
        " 'result', named_struct('application_id', concat('A', o_orderkey))))))"
    )
    by_status = (
        "to_json(named_struct('status', if(o_orderpriority = '5-LOW', 'down', 'Success'),"
        " 'data', named_struct('loan_lender_application_id', o_orderkey + 1)))"
    )
    body = (
        f"CASE o_orderstatus WHEN 'O' THEN {wrapped} WHEN 'F' THEN {by_status}"
        " ELSE '{\"error\":null}' END"
    )
    bodies = parse_bodies(
        spread(table(spark, sf_dir, "orders")).selectExpr("o_orderkey", f"{body} AS body")
    )
    outcomes = once(bodies, outcome=single_outcome()).selectExpr("o_orderkey", "outcome.*")
    return with_new_id(outcomes).select("o_orderkey", "is_success", "v2_value")


@query(
    """
    SELECT l_returnflag,
           sum(CASE WHEN l_linestatus = 'O' THEN 2 ELSE 1 END)::BIGINT AS n_success,
           sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END)::BIGINT AS n_failure,
           (2 * count(*))::BIGINT AS n_results, 0::BIGINT AS stated_success,
           0::BIGINT AS stated_failure, (2 * count(*))::BIGINT AS stated_total
    FROM lineitem GROUP BY l_returnflag
    """
)
def response_bulk_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item answers for two records; the second one depends on its status."""
    results = (
        "array(named_struct('statusCode', 200, 'data', named_struct('application_id', l_partkey)),"
        " named_struct('statusCode', if(l_linestatus = 'O', 200, 500),"
        " 'data', named_struct('application_id', l_suppkey)))"
    )
    body = (
        f"to_json(named_struct('api_response', to_json(named_struct('result', {results})),"
        " 'total_records_count', 2))"
    )
    bodies = parse_bodies(
        spread(table(spark, sf_dir, "lineitem")).selectExpr("l_returnflag", f"{body} AS body")
    )
    stated = [f"{bulk_total(name)} AS {name}" for name in TOTAL_FIELDS]
    return (
        once(bodies, results=bulk_results())
        .selectExpr("l_returnflag", "results", *stated)
        .selectExpr(
            "*",
            "size(filter(results, r -> r.is_success)) AS ok",
            "size(filter(results, r -> NOT r.is_success)) AS bad",
        )
        .groupBy("l_returnflag")
        .agg(
            F.sum("ok").alias("n_success"),
            F.sum("bad").alias("n_failure"),
            F.sum(F.expr("ok + bad")).alias("n_results"),
            F.sum(TOTAL_FIELDS[0]).alias("stated_success"),
            F.sum(TOTAL_FIELDS[1]).alias("stated_failure"),
            F.sum(TOTAL_FIELDS[2]).alias("stated_total"),
        )
    )


# --- payloads ---------------------------------------------------------------------------


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS sk, 'organization' AS entity_id, c_name AS name,
           c_acctbal >= 0 AS is_active, c_mktsegment AS team, CAST(c_nationkey AS DOUBLE) AS nation
    FROM customer
    """
)
def payload_organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "customer"),
        "c_custkey",
        image(
            "organization",
            n("c_custkey"),
            organization_is_active=s("if(c_acctbal >= 0, 'YES', 'no')"),
            teamCode=s("c_mktsegment"),
            name=s("c_name"),
            nation=n("c_nationkey"),
        ),
    )
    return read_app_request(
        build_requests(decoded, SPECS["organization"], CONFIG),
        "name string, organization_is_active boolean, team_id string, nation double",
        "sk",
        "get_json_object(payload, '$.entity_id') AS entity_id",
        "p.name",
        "p.organization_is_active AS is_active",
        "p.team_id AS team",
        "p.nation",
    )


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS sk,
           CASE WHEN c_acctbal >= 0 THEN 'v2-' || s_suppkey END AS organization_id,
           CASE WHEN c_acctbal >= 0 THEN s_name END AS group_name,
           CASE WHEN c_acctbal >= 0 THEN s_suppkey || '|' || s_nationkey END AS user_ids,
           CASE WHEN c_acctbal >= 0 THEN NULL
                ELSE 'v2_not_found:organization:' || s_suppkey END AS failure
    FROM supplier LEFT JOIN customer ON s_suppkey = c_custkey
    """
)
def payload_user_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        image(
            "user_group",
            n("s_suppkey"),
            organization_id=n("s_suppkey"),
            group_name=s("s_name"),
            user_ids=s("concat('[', s_suppkey, ', ', s_nationkey, ']')"),
        ),
    )
    ledger = ledger_of(
        table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0"
    )
    return read_app_request(
        build_requests(decoded, SPECS["user_group"], CONFIG, ledger),
        "organization_id string, group_name string, user_ids array<string>",
        "sk",
        "p.organization_id",
        "p.group_name",
        "array_join(p.user_ids, '|') AS user_ids",
        "failure",
    )


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS sk,
           CASE WHEN c_acctbal >= 0 THEN 'v2-' || p_partkey END AS organization_id,
           CASE WHEN c_acctbal >= 0 AND s_acctbal >= 0 THEN 'v2-' || p_size END AS user_group_id,
           CASE WHEN c_acctbal >= 0 THEN p_name END AS account_name,
           CASE WHEN c_acctbal >= 0 THEN
                CASE WHEN p_type = 'ECONOMY' THEN CAST(0 AS BIGINT)
                     ELSE CAST(trunc(p_retailprice) AS BIGINT) END END AS commission,
           CASE WHEN c_acctbal >= 0 THEN false END AS is_archived,
           CASE WHEN c_acctbal >= 0 THEN NULL
                ELSE 'v2_not_found:organization:' || p_partkey END AS failure
    FROM part LEFT JOIN customer ON p_partkey = c_custkey
              LEFT JOIN supplier ON p_size = s_suppkey
    """
)
def payload_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "part"),
        "p_partkey",
        image(
            "account",
            n("p_partkey"),
            organization_id=n("p_partkey"),
            user_group_id=s("p_size"),
            account_name=s("p_name"),
            account_type=s("p_type"),
            commission=f"if(p_type = 'ECONOMY', NULL, {n('p_retailprice')})",
        ),
    )
    ledger = ledger_of(
        table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0"
    ).unionByName(
        ledger_of(table(spark, sf_dir, "supplier"), "user_group", "s_suppkey", "s_acctbal >= 0")
    )
    return read_app_request(
        build_requests(decoded, SPECS["account"], CONFIG, ledger),
        "organization_id string, user_group_id string, account_name string, commission bigint,"
        " is_archived boolean",
        "sk",
        "p.organization_id",
        "p.user_group_id",
        "p.account_name",
        "p.commission",
        "p.is_archived",
        "failure",
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS sk,
           CASE WHEN c_acctbal >= 0 AND (o_orderstatus <> 'O' OR s_acctbal >= 0)
                THEN 'v2-' || o_custkey END AS organization_id,
           CASE WHEN c_acctbal >= 0 AND o_orderstatus = 'O' AND s_acctbal >= 0
                THEN 'v2-' || s_suppkey END AS team_lead_user_id,
           CASE WHEN c_acctbal >= 0 AND (o_orderstatus <> 'O' OR s_acctbal >= 0)
                THEN CAST(epoch(o_orderdate) AS BIGINT) END AS date_of_joining,
           CASE WHEN c_acctbal >= 0 AND (o_orderstatus <> 'O' OR s_acctbal >= 0)
                THEN CAST(o_custkey AS VARCHAR) END AS agent_title,
           CASE WHEN c_acctbal >= 0 AND (o_orderstatus <> 'O' OR s_acctbal >= 0)
                THEN round(o_totalprice, 2) END AS price,
           CASE WHEN c_acctbal IS NULL OR c_acctbal < 0
                THEN 'v2_not_found:organization:' || o_custkey
                WHEN o_orderstatus = 'O' AND (s_acctbal IS NULL OR s_acctbal < 0)
                THEN 'v2_not_found:user:' || (o_custkey // 10) END AS failure
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
                LEFT JOIN supplier ON o_custkey // 10 = s_suppkey
    """
)
def payload_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders have a team lead, looked up among suppliers."""
    decoded = records(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image(
            "user",
            n("o_orderkey"),
            organization_id=n("o_custkey"),
            team_lead_user_id=f"if(o_orderstatus = 'O', {s('o_custkey DIV 10')}, NULL)",
            date_of_joining=s("CAST(o_orderdate AS STRING)"),
            agent_title=n("o_custkey"),
            price=n("o_totalprice"),
        ),
    )
    ledger = ledger_of(
        table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0"
    ).unionByName(
        ledger_of(table(spark, sf_dir, "supplier"), "user", "s_suppkey", "s_acctbal >= 0")
    )
    return read_payload(
        build_requests(decoded, SPECS["user"], CONFIG, ledger),
        "data struct<organization_id:string,team_lead_user_id:string,date_of_joining:bigint,"
        "agent_title:string,price:double>",
        "sk",
        "p.data.organization_id",
        "p.data.team_lead_user_id",
        "p.data.date_of_joining",
        "p.data.agent_title",
        "round(p.data.price, 2) AS price",
        "failure",
    )


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS sk, s_acctbal >= 0 AS is_lender_type, s_name AS lender_name,
           CAST(trunc(s_acctbal) AS BIGINT) AS ratio,
           CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS VARCHAR) END AS city,
           CASE WHEN s_acctbal < 0 THEN 'no_address' END AS reject_reason
    FROM supplier
    """
)
def payload_lender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a negative balance are offline and have no address."""
    decoded = records(
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        image(
            "lender",
            n("s_suppkey"),
            is_lender_offline=b("s_acctbal < 0"),
            lender_name=s("s_name"),
            lender_buydown_ratio=n("s_acctbal"),
            lender_address=f"if(s_acctbal < 0, NULL, {many(m(city=s('s_nationkey')))})",
        ),
    )
    info = "lender_basic_info"
    return read_payload(
        build_requests(decoded, SPECS["lender"], CONFIG),
        "data struct<lender_basic_info:struct<is_lender_type:boolean,lender_name:string,"
        "lender_buydown_ratio:bigint>,lender_address:struct<city:string>>",
        "sk",
        f"p.data.{info}.is_lender_type",
        f"p.data.{info}.lender_name",
        f"p.data.{info}.lender_buydown_ratio AS ratio",
        "p.data.lender_address.city",
        "reject_reason",
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity,
           round(sum(l_extendedprice), 2) AS price, 'https://target.invalid/mock/deal_notes' AS endpoint
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def payload_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        image(
            "deal_note",
            n("l_orderkey"),
            flag=s("l_returnflag"),
            detail=m(
                status=s("l_linestatus"), quantity=n("l_quantity"), price=n("l_extendedprice")
            ),
        ),
    )
    rows = read_payload(
        build_requests(decoded, SPECS["deal_note"], CONFIG),
        "flag string, detail struct<status:string,quantity:double,price:double>",
        "p.flag AS l_returnflag",
        "p.detail.status AS l_linestatus",
        "p.detail.quantity AS q",
        "p.detail.price AS x",
        "endpoint",
    )
    return rows.groupBy("l_returnflag", "l_linestatus", "endpoint").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("q"), 2).alias("quantity"),
        F.round(F.sum("x"), 2).alias("price"),
    )


@query(
    """
    SELECT conv_id || '-' || turn AS sk, role, text,
           'https://target.invalid/contact_note' AS endpoint, '201' AS header
    FROM conversations
    """
)
def payload_contact_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "conversations"),
        "conv_id",
        image("contact_note", s("concat(conv_id, '-', turn)"), role=s("role"), text=s("text")),
    )
    return read_payload(
        build_requests(decoded, SPECS["contact_note"], CONFIG),
        "role string, text string",
        "sk",
        "p.role",
        "p.text",
        "endpoint",
        "headers['x-mock-response-code'] AS header",
    )


@query(
    """
    SELECT pk, CAST(o_orderkey AS VARCHAR) AS sk, o_orderpriority AS title, round(o_totalprice, 2) AS price,
           CAST(o_custkey AS DOUBLE) AS customer, endpoint, false AS has_size, 'q' AS inner_size
    FROM orders, (VALUES ('deal', 'https://target.invalid/mock/fees'),
                         ('deal_task', 'https://target.invalid/mock/deal_tasks'),
                         ('contact_task', 'https://target.invalid/contact_task')) AS kinds(pk, endpoint)
    """
)
def payload_deals_and_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said of deals and tasks; a size attribute of the store is dropped, but not inside values."""
    kinds = ("deal", "deal_task", "contact_task")
    requests = [
        build_requests(
            records(
                table(spark, sf_dir, "orders"),
                "o_orderkey",
                image(
                    kind,
                    n("o_orderkey"),
                    title=s("o_orderpriority"),
                    price=n("o_totalprice"),
                    SizeBytes=n("length(o_orderpriority)"),
                    detail=m(customer=n("o_custkey"), SizeBytes=s("'q'")),
                ),
            ),
            SPECS[kind],
            CONFIG,
        )
        for kind in kinds
    ]
    return read_payload(
        requests[0].unionByName(requests[1]).unionByName(requests[2]),
        "title string, price double, SizeBytes string, detail struct<customer:double,SizeBytes:string>",
        "pk",
        "sk",
        "p.title",
        "round(p.price, 2) AS price",
        "p.detail.customer",
        "endpoint",
        "p.SizeBytes IS NOT NULL AS has_size",
        "p.detail.SizeBytes AS inner_size",
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS sk,
           CASE WHEN o_orderstatus = 'O' AND c_acctbal >= 0 THEN 'v2-' || o_custkey END AS organization_id,
           CASE WHEN o_orderstatus <> 'O' THEN 'v2_not_found:organization:'
                WHEN c_acctbal >= 0 THEN NULL ELSE 'v2_not_found:organization:' || o_custkey END AS failure
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """
)
def lookup_blank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders name their organization; of the others it is an empty text, or left out."""
    decoded = records(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image(
            "user_group",
            n("o_orderkey"),
            organization_id=f"CASE o_orderstatus WHEN 'O' THEN {s('o_custkey')} WHEN 'F' THEN {s(lit(''))} END",
        ),
    )
    ledger = ledger_of(table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0")
    return read_app_request(
        build_requests(decoded, SPECS["user_group"], CONFIG, ledger),
        "organization_id string",
        "sk",
        "p.organization_id",
        "failure",
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS sk, CASE WHEN c_acctbal >= 0 THEN CAST(o_custkey AS DOUBLE) END AS lead,
           CASE WHEN c_acctbal >= 0 THEN NULL ELSE 'v2_not_found:organization:' || o_custkey END AS failure
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """
)
def payload_numeric_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A team lead that is a number is not looked up, but passed on."""
    decoded = records(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image("user", n("o_orderkey"), organization_id=n("o_custkey"), team_lead_user_id=n("o_custkey")),
    )
    ledger = ledger_of(table(spark, sf_dir, "customer"), "organization", "c_custkey", "c_acctbal >= 0")
    return read_payload(
        build_requests(decoded, SPECS["user"], CONFIG, ledger),
        "data struct<team_lead_user_id:double>",
        "sk",
        "p.data.team_lead_user_id AS lead",
        "failure",
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, o_orderpriority AS fms FROM orders")
def payload_fms(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image("deal", n("o_orderkey"), deal_id=s("o_orderkey"), fms=s("o_orderpriority")),
    )
    return read_payload(
        build_requests(decoded, FMS, CONFIG), "deal_id string, fms string", "p.deal_id", "p.fms"
    )


# --- ledger and whole flows -------------------------------------------------------------


@query(
    """
    SELECT event_type AS pk,
           CASE WHEN value >= 10 THEN 'success#' ELSE 'failed#' END || user_id AS sk,
           CASE WHEN value >= 10 THEN 'v2-' || event_id END AS v2_value, event_id AS seq
    FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, user_id, value >= 10
                               ORDER BY event_id DESC) = 1
    """
)
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of events: responses become ledger rows, of which the last per key stays."""
    body = (
        "if(value >= 10, to_json(named_struct('data',"
        " named_struct('application_id', concat('v2-', event_id)))), '{\"status\":false}')"
    )
    log = spread(table(spark, sf_dir, "events")).selectExpr(
        "event_type AS pk",
        "CAST(user_id AS STRING) AS sk",
        "CAST(user_id AS STRING) AS base_key",
        "event_id AS seq",
        "event_type AS step",
        "'' AS pos",
        "false AS bulk",
        "props AS payload",
        "CAST(NULL AS STRING) AS failure",
        "CAST(NULL AS STRING) AS reject_reason",
        "200 AS status",
        f"{body} AS body",
        "1 AS attempts",
        "CAST(NULL AS STRING) AS transport_error",
    )
    return latest(ledger_rows(settle(log), 0)).select("pk", "sk", "v2_value", "seq")


def open_transport() -> Callable[[dict, int], tuple[int, str]]:
    """Deterministic target system: keys divisible by 11 fail, by 7 need a second attempt."""

    def send(request: dict, attempt: int) -> tuple[int, str]:
        key = int("".join(c for c in request["base_key"].split("#")[0] if c.isdigit()) or 0)
        if key % 7 == 0 and attempt == 0:
            return 401, "{}"
        if key % 11 == 0:
            return 500, "{}"
        new = f"v2-{request['base_key']}"
        if request["bulk"]:
            body = json.loads(json.loads(request["payload"])["api_request"])
            results = [
                {"statusCode": 200, "data": {"application_id": f"{new}-{i}"}}
                for i in range(len(body["record_create_list"]))
            ]
            return 200, json.dumps({"api_response": json.dumps({"result": results})})
        ids = {"application_id": new, "loan_lender_application_id": f"L{key}"}
        return 200, json.dumps({"data": ids})

    return send


def migrate(spark: SparkSession, name: str, *batches: DataFrame) -> LedgerStore:
    """Run batches into a new ledger."""
    store = LedgerStore(spark, new_scratch_path(spark, name))
    for batch_id, batch in enumerate(batches):
        run_batch(batch, batch_id, store, open_transport, CONFIG)
    return store


@query(
    """
    WITH RECURSIVE org AS (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0),
    usr AS (
        SELECT o_orderkey, o_orderkey % 11 <> 0 AND o_custkey IN (SELECT c_custkey FROM org) AS ok,
               CASE WHEN o_orderstatus = 'P' THEN o_orderkey // 100 END AS lead
        FROM orders),
    chain AS (
        SELECT o_orderkey, ok FROM usr WHERE lead IS NULL
        UNION ALL
        SELECT u.o_orderkey, u.ok AND chain.ok FROM usr u JOIN chain ON u.lead = chain.o_orderkey),
    outcomes AS (
        SELECT 'organization' AS pk, c_custkey % 11 <> 0 AS ok FROM customer
        UNION ALL
        SELECT 'user', coalesce(chain.ok, false)
        FROM usr LEFT JOIN chain ON usr.o_orderkey = chain.o_orderkey
        UNION ALL
        SELECT 'account', p_partkey % 11 <> 0 AND p_partkey IN (SELECT c_custkey FROM org) FROM part
        UNION ALL
        SELECT 'deal_note', key % 11 <> 0
        FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS key FROM lineitem))
    SELECT pk, CASE WHEN ok THEN 'success' ELSE 'failed' END AS result, count(*) AS n
    FROM outcomes GROUP BY 1, 2
    """
)
def migration_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, orders, parts and line items migrate as one batch."""
    batch = changes(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        image(
            "deal_note",
            n("l_orderkey * 10 + l_linenumber"),
            flag=s("l_returnflag"),
            price=n("l_extendedprice"),
        ),
    )
    batch = batch.unionByName(
        changes(
            table(spark, sf_dir, "orders"),
            "o_orderkey",
            image(
                "user",
                n("o_orderkey"),
                organization_id=n("o_custkey"),
                team_lead_user_id=f"if(o_orderstatus = 'P', {s('o_orderkey DIV 100')}, NULL)",
                date_of_joining=s("CAST(o_orderdate AS STRING)"),
            ),
        )
    )
    batch = batch.unionByName(
        changes(
            table(spark, sf_dir, "part"),
            "p_partkey",
            image(
                "account",
                n("p_partkey"),
                organization_id=n("p_partkey"),
                account_name=s("p_name"),
                commission=n("p_retailprice"),
            ),
        )
    )
    batch = batch.unionByName(
        changes(
            table(spark, sf_dir, "customer"),
            "c_custkey",
            image(
                "organization",
                n("c_custkey"),
                organization_is_active=s("if(c_acctbal >= 0, 'yes', 'no')"),
                teamCode=s("c_name"),
            ),
        )
    )
    return outcome_count(migrate(spark, "migration", batch).current("result"))


@query(
    """
    WITH lenders AS (SELECT *, s_suppkey % 11 <> 0 AS ok FROM supplier WHERE s_acctbal >= 0),
    deals AS (SELECT *, o_orderkey % 11 <> 0 AS ok,
                     CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS n_maps FROM orders),
    outcomes AS (
        SELECT 'lender' AS pk, ok, 1 AS n FROM lenders
        UNION ALL SELECT 'lender', true, 2 FROM lenders WHERE ok
        UNION ALL SELECT 'lender', false, 1 FROM lenders WHERE NOT ok
        UNION ALL SELECT 'deal', ok, 1 FROM deals
        UNION ALL SELECT 'deal', ok, n_maps * 3 FROM deals
        UNION ALL SELECT 'deal', true, 2 + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END
                  FROM deals WHERE ok)
    SELECT pk, CASE WHEN ok THEN 'success' ELSE 'failed' END AS result, sum(n)::BIGINT AS n
    FROM outcomes GROUP BY 1, 2
    """
)
def migration_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenders with managers (suppliers) and deals with children (orders) as one batch."""
    document = m(document_name=s("o_orderpriority"), document_path=s("o_orderkey"))
    full = m(deal_id=s("o_orderkey"), docs=many(document, document))
    deals = changes(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image(
            "deal",
            n("o_orderkey"),
            documents=f"if(o_orderstatus = 'O', {many(full, full)}, {many(full)})",
            fees=many(m(fee_id=s("'a'"), amount=n("o_totalprice")), m(fee_id=s("'b'"), amount=n("1"))),
            participants=f"if(o_orderstatus = 'O', {many(m(participant_id=s('o_custkey')))}, NULL)",
        ),
    )
    lenders = changes(
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        image(
            "lender",
            n("s_suppkey"),
            lender_buydown_ratio=n("s_acctbal"),
            lender_address=f"if(s_acctbal < 0, NULL, {many(m(city=s('s_nationkey')))})",
            lender_business_development_manager=many(m(name=s("s_name")), m(name=s("'x'"))),
        ),
    )
    return outcome_count(migrate(spark, "composite", deals.unionByName(lenders)).current("result"))


def open_counting() -> Callable[[dict, int], tuple[int, str]]:
    """States the totals of bulk requests; of parents divisible by 7 no record is created."""

    def send(request: dict, attempt: int) -> tuple[int, str]:
        if not request["bulk"]:
            return 200, json.dumps({"data": {"application_id": "v2"}})
        n_items = len(json.loads(json.loads(request["payload"])["api_request"])["record_create_list"])
        good = n_items if int(request["sk"]) % 7 else 0
        totals = dict(zip(TOTAL_FIELDS, (good, n_items - good, n_items), strict=True))
        results = [{"statusCode": 200 if good else 500, "data": {"application_id": "v2"}}] * n_items
        return 200, json.dumps({**totals, "api_response": json.dumps({"result": results})})

    return send


@query(
    """
    WITH deals AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 2 END AS n FROM orders)
    SELECT count(*) * 7 AS requests, count(*) * 7 AS sent,
           coalesce(sum(n) FILTER (WHERE o_orderkey % 7 <> 0), 0)::BIGINT AS stated_success,
           coalesce(sum(n) FILTER (WHERE o_orderkey % 7 = 0), 0)::BIGINT AS stated_failure,
           sum(n)::BIGINT AS stated_records
    FROM deals
    """
)
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a batch of orders with fees and participants, observed while its steps are written."""
    deals = changes(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        image(
            "deal",
            n("o_orderkey"),
            fees=many(m(fee_id=s("'a'"), amount=n("o_totalprice")), m(fee_id=s("'b'"), amount=n("1"))),
            participants=f"if(o_orderstatus = 'O', {many(m(participant_id=s('o_custkey')))}, NULL)",
        ),
    )
    store = LedgerStore(spark, new_scratch_path(spark, "totals"))
    totals = run_batch(deals, 0, store, open_counting, CONFIG).totals
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{name} long" for name in totals))


CONTACT_SQL = (
    MERGE_SQL.replace("CASE WHEN value >= 10 THEN value END", "CASE WHEN value >= 10 THEN props END")
    + """
    SELECT r.event_id, r.user_id, r.user_id % 11 <> 0 AS is_success,
           CASE WHEN r.user_id % 11 <> 0 THEN r.amount
                WHEN e.value >= 10 THEN e.props END AS first_name,
           CASE WHEN r.user_id % 11 <> 0 THEN r.n_roles ELSE 1 END AS n_roles
    FROM running r JOIN events e ON r.event_id = e.event_id
"""
)


@query(CONTACT_SQL)
def migration_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as contact records in two batches: what every request says, merged into what its
    user's contact is so far. The target refuses every 11th user, whose state never moves."""
    events = table(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).first()[0] // 2
    new_image = image(
        "contact",
        n("event_id"),
        email_id=s("user_id"),
        first_name=s("if(value >= 10, props, '')"),
        role_based_attributes=many(m(role=s(ROLE_OF))),
    )
    store = LedgerStore(spark, new_scratch_path(spark, "contacts"))
    logs = [
        run_batch(changes(events.filter(part), "event_id", new_image), k, store, open_transport, CONFIG).log
        for k, part in enumerate((f"event_id <= {half}", f"event_id > {half}"))
    ]
    said = "first_name string, role_based_attributes array<struct<role:string>>"
    return read_payload(
        logs[0].unionByName(logs[1]),
        said,
        "seq AS event_id",
        "CAST(base_key AS BIGINT) AS user_id",
        "is_success",
        "p.first_name AS first_name",
        "CAST(size(p.role_based_attributes) AS BIGINT) AS n_roles",
    )


@query(
    """
    WITH org AS (SELECT n_nationkey FROM nation WHERE n_nationkey % 11 <> 0),
    outcomes AS (
        SELECT 'organization' AS pk, n_nationkey % 11 <> 0 AS ok FROM nation
        UNION ALL
        SELECT 'user_group', s_suppkey % 11 <> 0 AND s_nationkey IN (SELECT n_nationkey FROM org)
        FROM supplier
        UNION ALL
        SELECT CASE event_type WHEN 'click' THEN 'contact_note' WHEN 'view' THEN 'contact_task'
                    ELSE 'deal_task' END, event_id % 11 <> 0 FROM events)
    SELECT pk, CASE WHEN ok THEN 'success' ELSE 'failed' END AS result, count(*) AS n
    FROM outcomes GROUP BY 1, 2
    """
)
def migration_groups_and_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as organizations, suppliers as user groups, events as notes and tasks."""
    nations = changes(table(spark, sf_dir, "nation"), "n_nationkey", image("organization", n("n_nationkey")))
    groups = changes(
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        image("user_group", n("s_suppkey"), organization_id=n("s_nationkey"), user_ids=s("'[1,2]'")),
    )
    kind = "CASE event_type WHEN 'click' THEN 'contact_note' WHEN 'view' THEN 'contact_task' ELSE 'deal_task' END"
    tasks = changes(
        table(spark, sf_dir, "events"),
        "event_id",
        f"to_json(named_struct('pk', {s(kind)}, 'sk', {n('event_id')}, 'note', {s('props')}))",
    )
    return outcome_count(migrate(spark, "groups", nations.unionByName(groups).unionByName(tasks)).current("result"))


STREAM_FILES = 12


def stage(changed: DataFrame, path: str) -> None:
    """Changes as JSON files of three arrivals, several files each; files are picked up in the order
    they were written."""
    staged = cut(changed)
    third, two_thirds = staged.approxQuantile("seq", [1 / 3, 2 / 3], 0.01)
    for arrival in (f"seq <= {third}", f"seq > {third} AND seq <= {two_thirds}", f"seq > {two_thirds}"):
        staged.filter(arrival).repartition(STREAM_FILES // 3).write.mode("append").json(path)


@query(CONTACT_SQL)
def stream_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same contacts as a stream in three triggers, whose state store holds what was accepted."""
    path = new_scratch_path(spark, "contact_stream")
    new_image = image(
        "contact",
        n("event_id"),
        email_id=s("user_id"),
        first_name=s("if(value >= 10, props, '')"),
        role_based_attributes=many(m(role=s(ROLE_OF))),
    )
    stage(changes(table(spark, sf_dir, "events"), "event_id", new_image), f"{path}/changes")
    logs: list[DataFrame] = []
    job = start_contacts(
        stream_json(spark, f"{path}/changes", max_files_per_trigger=STREAM_FILES // 3),
        LedgerStore(spark, f"{path}/ledger"),
        open_transport,
        f"{path}/checkpoint",
        CONFIG,
        available_now=True,
        on_log=lambda log, batch_id: logs.append(log),
    )
    job.awaitTermination()
    return read_payload(
        reduce(lambda a, b: a.unionByName(b), logs),
        "first_name string, role_based_attributes array<struct<role:string>>",
        "seq AS event_id",
        "CAST(base_key AS BIGINT) AS user_id",
        "is_success",
        "p.first_name AS first_name",
        "CAST(size(p.role_based_attributes) AS BIGINT) AS n_roles",
    )


@query(
    """
    SELECT CASE WHEN user_id % 11 <> 0 THEN 'success#' ELSE 'failed#' END || user_id || '-' || event_type
               AS sk,
           CASE WHEN user_id % 11 <> 0 THEN 'v2-' || user_id || '-' || event_type END AS v2_value,
           max(event_id) AS seq
    FROM events GROUP BY user_id, event_type
    """
)
def stream_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, staged as JSON files in order of arrival, replayed by the stream job."""
    path = new_scratch_path(spark, "stream")
    notes = image("deal_note", s("concat(user_id, '-', event_type)"), value=n("value"))
    stage(changes(table(spark, sf_dir, "events"), "event_id", notes), f"{path}/changes")
    store = LedgerStore(spark, f"{path}/ledger")
    job = start_migration(
        stream_json(spark, f"{path}/changes", max_files_per_trigger=STREAM_FILES // 3),
        store,
        open_transport,
        f"{path}/checkpoint",
        CONFIG,
        available_now=True,
        fanout=2,
    )
    job.awaitTermination()
    return store.current().select("sk", "v2_value", "seq")

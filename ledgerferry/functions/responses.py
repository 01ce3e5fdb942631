"""Reading the target system's responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerferry.functions.jsontext import lit, lits
from ledgerferry.functions.scalars import strip
from ledgerferry.operators.once import once

# What counts as success, and where an id is looked for.
OK_CODE_TEXT = "200"
OK_STATUS_TEXTS = ("OK", "SUCCESS")
ID_HOLDERS = ("result", "data", "response")
ID_FIELDS = ("application_id", "loan_lender_application_id")
TOTAL_FIELDS = (
    "total_record_created_success_count",
    "total_record_created_failure_count",
    "total_records_count",
)
OUTCOME = "struct<is_success:boolean,response:string,error:string>"
ENVELOPE_KEYS = ("api_response", "error", "status")


def allow_repeated_keys(spark: SparkSession) -> None:
    """Of a repeated key in JSON text the last value counts, on every path that parses it."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def json_at(value: str, path: str = "$") -> str:
    """JSON text at a path of a variant: null when absent, the text `null` for JSON null."""
    return f"to_json(variant_get({value}, {lit(path)}, 'variant'))"


def text_at(value: str, path: str) -> str:
    """String at a path; null when it is absent or not a string."""
    found = f"variant_get({value}, {lit(path)}, 'variant')"
    return (
        f"CASE WHEN schema_of_variant({found}) = 'STRING'"
        f" THEN variant_get({value}, {lit(path)}, 'string') END"
    )


def is_absent(value: str, path: str) -> str:
    """No such path; a JSON null is there."""
    return f"(variant_get({value}, {lit(path)}, 'variant') IS NULL)"


def is_object(text: str) -> str:
    return f"coalesce(startswith({strip(text)}, '{{'), false)"


def json_truthy(fragment: str) -> str:
    """False for absent, null, empty, false and zero JSON values."""
    zero = lit(r"^-?0+(\.0+)?([eE].*)?$")
    return (
        f"coalesce({fragment} NOT IN ('null', 'false', '\"\"', '{{}}', '[]')"
        f" AND NOT {fragment} RLIKE {zero}, false)"
    )


def json_items(value: str, path: str = "$") -> str:
    """Elements of the JSON array at a path as variants; null when it is no array."""
    return f"try_variant_get({value}, {lit(path)}, 'array<variant>')"


EMPTY_ITEMS = "CAST(array() AS array<variant>)"


def _outcome(success: str, response: str, error: str) -> str:
    return (
        f"named_struct('is_success', {success},"
        f" 'response', CASE WHEN {success} THEN {response} END,"
        f" 'error', CASE WHEN NOT {success} THEN {error} END)"
    )


def parse_bodies(rows: DataFrame, body: str = "body") -> DataFrame:
    """Parse each body once, into columns that the outcome rules share.

    Adds `value`, the body as a variant; whether it is `wrapped` or `errored`, and what
    status it `said`; `inner_text` and `inner`, the response that is wrapped in it as text;
    and `items`, text and status code of a wrapped list of results (empty when there is no
    list, null when it is something else).
    """
    allow_repeated_keys(rows.sparkSession)
    item = f"named_struct('json', to_json(x), 'code', {json_at('x', '$.statusCode')})"
    items = (
        f"transform(if({is_absent('inner', '$.result')}, {EMPTY_ITEMS},"
        f" {json_items('inner', '$.result')}), x -> {item})"
    )
    valued = once(rows, value=f"try_parse_json({body})")
    unwrapped = once(
        valued,
        wrapped=f"NOT {is_absent('value', '$.api_response')}",
        errored=f"NOT {is_absent('value', '$.error')}",
        said=json_at("value", "$.status"),
        inner_text=text_at("value", "$.api_response"),
    )
    return once(once(unwrapped, inner="try_parse_json(inner_text)"), items=items)


def single_outcome(body: str = "body") -> str:
    """Outcome of a single request, over the columns of `parse_bodies`.

    The first matching rule wins.
    """
    none = "CAST(NULL AS STRING)"
    code_ok = f"coalesce({json_at('inner', '$.statusCode')} = '\"{OK_CODE_TEXT}\"', false)"
    status_ok = (
        f"CASE WHEN said IN ('true', 'false') THEN said = 'true'"
        f" ELSE upper(coalesce({text_at('value', '$.status')}, '')) IN ({lits(OK_STATUS_TEXTS)}) END"
    )
    # An answer that is no object passes unless it mentions one of the envelope keys.
    listed = (
        f"exists({json_items('value')}, x -> to_json(x) IN"
        f" ({lits(tuple(f'\"{k}\"' for k in ENVELOPE_KEYS))}))"
    )
    bare_ok = (
        f"CASE WHEN startswith({strip(body)}, '[') THEN NOT {listed}"
        f" WHEN startswith({strip(body)}, '\"') THEN NOT {body} RLIKE {lit('|'.join(ENVELOPE_KEYS))}"
        f" ELSE false END"
    )

    def failed(message: str) -> str:
        return _outcome("false", none, lit(message))

    return (
        f"CASE WHEN value IS NULL THEN {failed('Response is not JSON')}"
        f" WHEN NOT {is_object(body)} THEN {_outcome(bare_ok, body, lit('Response is not an object'))}"
        f" WHEN wrapped THEN CASE"
        f" WHEN inner_text IS NULL THEN {failed('Api response is not text')}"
        f" WHEN inner IS NULL THEN {failed('Failed to parse api response')}"
        f" WHEN NOT {is_object('inner_text')} THEN {failed('Api response is not an object')}"
        f" ELSE {_outcome(code_ok, 'inner_text', 'inner_text')} END"
        f" WHEN errored THEN {_outcome('false', none, body)}"
        f" WHEN said IS NOT NULL THEN {_outcome(status_ok, body, body)}"
        f" ELSE {_outcome('true', body, none)} END"
    )


def bulk_results(body: str = "body") -> str:
    """Outcomes per record of a bulk request, over the columns of `parse_bodies`.

    Null when the answer cannot be read.
    """
    ok = (
        f"coalesce(NOT startswith(x.code, '\"')"
        f" AND try_cast(x.code AS DOUBLE) = {int(OK_CODE_TEXT)}, false)"
    )
    readable = (
        f"{is_object(body)} AND {is_object('inner_text')} AND inner IS NOT NULL"
        f" AND NOT exists(items, x -> NOT startswith(x.json, '{{'))"
    )
    return f"CASE WHEN {readable} THEN transform(items, x -> {_outcome(ok, 'x.json', 'x.json')}) END"


def bulk_error() -> str:
    """Why `bulk_results` is null."""
    return (
        "CASE WHEN wrapped THEN 'Failed to parse api response'"
        " ELSE 'Invalid response format' END"
    )


def bulk_total(name: str) -> str:
    """A total the bulk answer states; 0 when it does not."""
    total = json_at("value", f"$.{name}")
    return f"CASE WHEN {total} IS NULL THEN 0 ELSE try_cast({total} AS BIGINT) END"


def with_new_id(rows: DataFrame, response: str = "response") -> DataFrame:
    """Add `v2_value`, the id the target gave the record, as text; null when there is none.

    The first holder that is filled decides, and must be an object.
    """
    allow_repeated_keys(rows.sparkSession)
    parsed = once(rows, answer=f"try_parse_json({response})")
    seen = once(parsed, **{f"in_{h}": json_at("answer", f"$.{h}") for h in ID_HOLDERS})
    choices = "".join(
        f" WHEN {json_truthy(f'in_{h}')} THEN variant_get(answer, '$.{h}', 'variant')"
        for h in ID_HOLDERS
    )
    held = once(seen, holder=f"CASE{choices} END")
    named = once(held, **{f"as_{f}": json_at("holder", f"$.{f}") for f in ID_FIELDS})
    texts = "".join(
        f" WHEN {json_truthy(f'as_{f}')} THEN CASE"
        f" WHEN startswith(as_{f}, '\"') THEN variant_get(holder, '$.{f}', 'string')"
        f" WHEN as_{f} = 'true' THEN 'True' ELSE as_{f} END"
        for f in ID_FIELDS
    )
    return named.selectExpr(*rows.columns, f"CASE{texts} END AS v2_value")


def transport_failure() -> str:
    """Why a delivery failed before its body counts; null when the body decides."""
    return (
        "CASE WHEN transport_error IS NOT NULL THEN transport_error"
        " WHEN attempts = 0 THEN 'Max retries reached'"
        " WHEN status >= 400 THEN concat('HTTP ', status)"
        " WHEN value IS NULL THEN 'Response is not JSON' END"
    )

"""Request payloads of the entity flows, one spec per entity.

A spec turns an entity's decoded records into request rows. Payloads are made from the
attribute map, so whatever attributes a record carries pass through with their types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ledgerferry.config import MigrationConfig
from ledgerferry.functions.jsontext import json_array_of, json_object, lit, quote
from ledgerferry.functions.responses import json_at
from ledgerferry.functions.scalars import (
    to_boolean,
    to_epoch_seconds,
    to_integer,
    to_string_array,
)
from ledgerferry.functions.tagged import as_json, attr, has, record_json, text_of, truthy
from ledgerferry.operators.lookup import lookup, require
from ledgerferry.schemas import REQUEST
from ledgerferry.sources.ledger import LedgerView

# Keys no payload carries, and the header of the endpoints that answer with a
# canned status.
KEY_ATTRIBUTES = ("pk", "sk", "id")
CREATED_HEADER = {"x-mock-response-code": "201"}

MISSING_KEY = "missing_key"
NO_TEXT = "CAST(NULL AS STRING)"


@dataclass(frozen=True)
class ForeignKey:
    """An old id in a record: the new one, found in the ledger, becomes `column`.

    A record that meets `required` and whose id is not found fails.
    """

    entity: str
    key: str
    column: str
    required: str = "true"


@dataclass(frozen=True)
class EntitySpec:
    """How records of one entity become requests.

    `payload(config)` is the request body; `keys` are looked up before, and decide when the
    entity's records can go; `rejects` maps reasons to conditions. Bodies, keys and conditions
    are SQL expressions over decoded records. Of a `merged` entity, records with one base key
    are merged with what was accepted before, and go one after the other.
    """

    endpoint: str
    payload: Callable[[MigrationConfig], str]
    suffix: str = ""
    headers: dict[str, str] = field(default_factory=dict)
    keys: tuple[ForeignKey, ...] = ()
    rejects: dict[str, str] = field(default_factory=dict)
    base_key: str = "sk"
    merged: bool = False


def app_request(config: MigrationConfig, entity_id: str, body: str) -> str:
    """Envelope that carries the body as embedded JSON text."""
    return json_object(
        {
            "wfe_app_id": lit(f'"{config.app_id}"'),
            "entity_id": lit(f'"{entity_id}"'),
            "api_request": quote(body),
        }
    )


def user_request(config: MigrationConfig, body: str) -> str:
    """Envelope that names who acts."""
    return json_object(
        {
            "user_id": lit(f'"{config.acting_user_id}"'),
            "user_role": lit(f'"{config.acting_user_role}"'),
            "data": body,
        }
    )


def header_map(headers: dict[str, str]) -> str:
    pairs = ", ".join(f"{lit(k)}, {lit(v)}" for k, v in headers.items())
    return f"CAST(map({pairs}) AS map<string,string>)"


def id_text(name: str) -> str:
    """Scalar text of an attribute, as lookups use it."""
    return text_of(attr(name), "S", "N", "BOOL")


def boolean_json(a: str) -> str:
    return (
        f"CASE {a}.tag WHEN 'BOOL' THEN {a}.text"
        f" WHEN 'S' THEN CAST({to_boolean(a + '.text')} AS STRING) END"
    )


def epoch_json(a: str) -> str:
    return f"CASE WHEN {a}.tag = 'S' THEN CAST({to_epoch_seconds(a + '.text')} AS STRING) END"


def string_json(a: str) -> str:
    """Any value as a JSON string; null stays null."""
    return (
        f"CASE {a}.tag WHEN 'NULL' THEN NULL WHEN 'BOOL' THEN {quote(f'initcap({a}.text)')}"
        f" ELSE {quote(a + '.text')} END"
    )


def not_text(name: str) -> str:
    """The attribute is neither text nor empty, so a text conversion cannot read it."""
    return f"({attr(name)}.tag NOT IN ('S', 'NULL') AND {truthy(attr(name))})"


def pass_through(config: MigrationConfig) -> str:
    return record_json(KEY_ATTRIBUTES)


def organization_payload(config: MigrationConfig) -> str:
    body = record_json(
        KEY_ATTRIBUTES, {"organization_is_active": boolean_json}, config.renames
    )
    return app_request(config, config.entity_ids["organization"], body)


def user_group_payload(config: MigrationConfig) -> str:
    members = to_string_array(text_of(attr("user_ids"), "S"))
    user_ids = json_array_of(f"transform({members}, u -> {quote('u')})")
    body = json_object(
        {
            "organization_id": quote("organization_v2"),
            "group_name": as_json(attr("group_name")),
            "user_ids": f"CASE WHEN {has('user_ids')} THEN {user_ids} END",
        }
    )
    return app_request(config, config.entity_ids["user_group"], body)


COMMISSION = (
    f"CASE WHEN coalesce({attr('commission')}.tag, 'NULL') = 'NULL' THEN CAST(0 AS BIGINT)"
    f" ELSE {to_integer(attr('commission'))} END"
)


def account_payload(config: MigrationConfig) -> str:
    body = json_object(
        {
            "organization_id": quote("organization_v2"),
            **{
                name: as_json(attr(name))
                for name in ("account_name", "account_type", "description", "campaign_name")
            },
            "commission": f"CAST({COMMISSION} AS STRING)",
            "is_archived": "'false'",
            "user_group_id": quote("user_group_v2"),
        }
    )
    return app_request(config, config.entity_ids["account"], body)


def user_payload(config: MigrationConfig) -> str:
    body = record_json(
        KEY_ATTRIBUTES,
        {
            "organization_id": lambda a: quote("organization_v2"),
            "team_lead_user_id": lambda a: (
                f"CASE WHEN {a}.tag = 'S' THEN {quote('team_lead_v2')} ELSE {as_json(a)} END"
            ),
            "date_of_birth": epoch_json,
            "date_of_joining": epoch_json,
            "agent_title": string_json,
        },
    )
    return user_request(config, body)


def first_address() -> str:
    return (
        f"CASE WHEN {attr('lender_address')}.tag = 'L'"
        f" THEN {json_at(f'try_parse_json({attr("lender_address")}.text)', '$[0]')} END"
    )


def lender_payload(config: MigrationConfig) -> str:
    plain = (
        "lender_description",
        "lender_phone",
        "is_active",
        "website",
        "lender_spotlight_id",
    )
    info = json_object(
        {
            "is_lender_type": f"CAST(NOT {truthy(attr('is_lender_offline'))} AS STRING)",
            "lender_name": as_json(attr("lender_name")),
            "lender_type": as_json(attr("lender_type")),
            "lender_buydown_ratio": f"CAST({to_integer(attr('lender_buydown_ratio'))} AS STRING)",
            **{name: as_json(attr(name)) for name in plain},
        }
    )
    body = json_object({"lender_basic_info": info, "lender_address": first_address()})
    return user_request(config, body)


def fms_payload(config: MigrationConfig) -> str:
    return json_object({"deal_id": as_json(attr("deal_id")), "fms": as_json(attr("fms"))})


ORGANIZATION = ForeignKey("organization", id_text("organization_id"), "organization_v2")
USER_GROUP = ForeignKey("user_group", id_text("user_group_id"), "user_group_v2", required="false")
# A team lead is required only where one is given as text.
LEAD_ID = text_of(attr("team_lead_user_id"), "S")
TEAM_LEAD = ForeignKey("user", LEAD_ID, "team_lead_v2", required=f"{LEAD_ID} IS NOT NULL")


def resolve(
    records: DataFrame, keys: tuple[ForeignKey, ...], ledger_rows: DataFrame | LedgerView
) -> DataFrame:
    """Records with the new ids of their keys, and `failure` where a required one is missing;
    of several the first counts."""
    found = lookup(records, ledger_rows, **{k.column: (k.entity, k.key) for k in keys})
    for k in keys:
        found = require(found, k.entity, k.key, k.column, where=k.required)
    return found


SPECS: dict[str, EntitySpec] = {
    "organization": EntitySpec(
        "org",
        organization_payload,
        rejects={
            "bad_boolean": f"({not_text('organization_is_active')}"
            f" AND {attr('organization_is_active')}.tag <> 'BOOL')"
        },
    ),
    "user_group": EntitySpec("org", user_group_payload, keys=(ORGANIZATION,)),
    "account": EntitySpec(
        "org",
        account_payload,
        keys=(ORGANIZATION, USER_GROUP),
        rejects={"bad_integer": f"({COMMISSION}) IS NULL"},
    ),
    "user": EntitySpec(
        "user",
        user_payload,
        keys=(ORGANIZATION, TEAM_LEAD),
        rejects={"bad_date": f"({not_text('date_of_birth')} OR {not_text('date_of_joining')})"},
    ),
    "lender": EntitySpec(
        "lender",
        lender_payload,
        rejects={
            "bad_integer": f"({to_integer(attr('lender_buydown_ratio'))}) IS NULL",
            "no_address": f"({first_address()}) IS NULL",
        },
    ),
    "contact": EntitySpec(
        "contact",
        pass_through,
        headers=CREATED_HEADER,
        base_key=id_text("email_id"),
        merged=True,
    ),
    "contact_note": EntitySpec("contact_note", pass_through, headers=CREATED_HEADER),
    "contact_task": EntitySpec("contact_task", pass_through, headers=CREATED_HEADER),
    "deal": EntitySpec("mock", pass_through, suffix="/fees", headers=CREATED_HEADER),
    "deal_note": EntitySpec("mock", pass_through, suffix="/deal_notes", headers=CREATED_HEADER),
    "deal_task": EntitySpec("mock", pass_through, suffix="/deal_tasks", headers=CREATED_HEADER),
}

# A builder without a flow of its own.
FMS = EntitySpec("org", fms_payload, headers=CREATED_HEADER)


def build_requests(
    records: DataFrame,
    spec: EntitySpec,
    config: MigrationConfig,
    ledger_rows: DataFrame | LedgerView | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Request rows of an entity's records. A failed lookup keeps the record as payload.

    Records whose keys are resolved already carry a `failure` column. `extra` are expressions
    to keep beside the requests.
    """
    resolved = "failure" in records.columns
    if resolved or spec.keys:
        rows = records if resolved else resolve(records, spec.keys, ledger_rows)
        payload = f"if(failure IS NULL, {spec.payload(config)}, {record_json()})"
    else:
        rows = records.selectExpr("*", f"{NO_TEXT} AS failure")
        payload = spec.payload(config)
    # A failed lookup comes first: the payload is not looked at any further.
    conditions = "".join(
        f" WHEN failure IS NULL AND {condition} THEN {lit(reason)}"
        for reason, condition in spec.rejects.items()
    )
    reject = f"CASE WHEN coalesce({spec.base_key}, '') = '' THEN '{MISSING_KEY}'{conditions} END"
    built = {
        "pk": "pk",
        "sk": "sk",
        "base_key": spec.base_key,
        "seq": "seq",
        "step": "pk",
        "pos": "''",
        "bulk": "false",
        "endpoint": lit(config.endpoint(spec.endpoint, spec.suffix)),
        "headers": header_map(spec.headers),
        "payload": payload,
        "failure": "failure",
        "reject_reason": reject,
        "n_items": "CAST(NULL AS INT)",
    }
    return rows.selectExpr(*[f"{built[name]} AS {name}" for name in REQUEST.names], *extra)

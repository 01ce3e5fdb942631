"""Schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Change envelope. The new row image stays raw JSON text: every record may carry
# other attributes, so no flat schema can be inferred for it.
ENVELOPE = T.StructType(
    [
        T.StructField("eventName", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("dynamodb", T.StructType([T.StructField("NewImage", T.StringType())])),
    ]
)

# Nesting levels that one parse takes apart. Every level is one more lambda for the analyzer to
# resolve; deeper values are parsed again, in the rounds of `decode_deep`.
NATIVE_DEPTH = 4


def tagged_value(depth: int) -> str:
    """One tagged value as it arrives: exactly one field is filled.

    Below `depth` levels maps and lists keep their raw JSON text.
    """
    inner = tagged_value(depth - 1) if depth else None
    nested = f"M:map<string,{inner}>,L:array<{inner}>" if depth else "M:string,L:string"
    return (
        "struct<S:string,N:string,B:string,BOOL:boolean,`NULL`:boolean,"
        f"SS:array<string>,NS:array<string>,BS:array<string>,{nested}>"
    )


TAGGED_MAP = f"map<string,{tagged_value(NATIVE_DEPTH)}>"

# One decoded attribute: the tag it came with and its text. S, N, B and BOOL keep
# the scalar text; M, L and the sets hold plain (untagged) JSON; NULL has no text.
ATTRIBUTE = T.StructType(
    [T.StructField("tag", T.StringType()), T.StructField("text", T.StringType())]
)

DECODED = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("pk", T.StringType()),
        T.StructField("sk", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), ATTRIBUTE)),
        T.StructField("raw", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

# One unit of work of a batch: a request to deliver, or a record that cannot be
# delivered and says why (`failure` goes to the ledger, `reject_reason` to quarantine).
# `n_items` is the number of records a bulk request carries; single ones leave it null.
REQUEST = T.StructType(
    [
        T.StructField("pk", T.StringType()),
        T.StructField("sk", T.StringType()),
        T.StructField("base_key", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("step", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("bulk", T.BooleanType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.StringType()),
        T.StructField("failure", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("n_items", T.IntegerType()),
    ]
)

# What delivery adds to a request.
DELIVERY = T.StructType(
    [
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("transport_error", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("pk", T.StringType()),
        T.StructField("sk", T.StringType()),
        T.StructField("v1_value", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("v2_value", T.StringType()),
        T.StructField("errorMsg", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

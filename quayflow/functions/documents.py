"""JSON text: whole-text validation and the event envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A value of any size is valid; quotes and numbers are those of the JSON standard.
_ANY = str(2**31 - 1)
_STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": _ANY,
    "maxNumLen": _ANY,
    "maxNestingDepth": _ANY,
}

# From here on a text may be beyond what is read into a VARIANT: strings of 20 million
# characters, 128 MB in all.
LARGE_BYTES = 16 << 20


def _sealed(text: Column) -> Column:
    """The text as an array's first element, its own digest as the second.

    Parsers stop where their value ends and accept whatever follows. If the second element
    is the digest, the text before it was one value: it cannot hold its own digest.
    """
    return F.concat(F.lit("["), text, F.lit(',"'), F.md5(text.cast("binary")), F.lit('"]'))


def is_json(text: Column) -> Column:
    """Whether a text is exactly one JSON value; repeated keys are allowed.

    Numbers and texts may have any length. Arrays and objects may be nested some 990 deep,
    which is as deep as Spark's parser writes a value out.
    """
    elements = F.from_json(_sealed(text), "array<string>", _STRICT)
    seal = F.get(elements, F.lit(1)) == F.md5(text.cast("binary"))
    return F.coalesce(seal & (F.size(elements) == 2), F.lit(False))


def parse_json(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    Of repeated keys the last counts where ``spark.sql.variant.allowDuplicateKeys`` is
    set, as the library's session settings do. Texts with a string of over 20 million
    characters or beyond 128 MB, far above what brokers accept by default, are NULL.
    """
    sealed = F.try_parse_json(_sealed(text))
    seal = F.try_variant_get(sealed, "$[1]", "string") == F.md5(text.cast("binary"))
    return F.when(seal, F.variant_get(sealed, "$[0]", "variant"))


def event_json(
    event_source: str,
    event_version: int,
    producer_ts: Column,
    monitoring_ref: Column,
    payload: Column,
) -> Column:
    """Envelope around a payload that is already valid JSON text.

    The payload goes in as received, so its numbers, key order and accents stay
    as they are and it is not serialised again.
    """
    head = F.to_json(
        F.struct(
            F.lit(event_source).alias("event_source"),
            F.lit(event_version).alias("event_version"),
            producer_ts.alias("producer_ts"),
            monitoring_ref.alias("monitoring_ref"),
        ),
        {"ignoreNullFields": "false"},
    )
    open_head = F.substring(head, F.lit(1), F.length(head) - 1)
    return F.concat(open_head, F.lit(',"payload":'), payload, F.lit("}"))

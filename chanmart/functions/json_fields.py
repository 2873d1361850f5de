"""Column expressions over raw message JSON.

Two layers:

* ingest validation works on the VARIANT produced by ``try_parse_json`` (one
  parse per file, JVM side) and classifies every file with a reject reason;
* the staging model reads fields from the normalised JSON text kept in the raw
  table, parsing it once per row (``parse_json``) and pulling each path out of
  the binary variant, the way ``->>`` pulls text out of a JSON column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reject reasons, in the order the loader meets them.
BAD_JSON = "bad_json"
NOT_OBJECT = "not_object"
BAD_PEER = "bad_peer"
MISSING_ID = "missing_id"
BAD_ID = "bad_id"
BAD_CHANNEL = "bad_channel"
NUL_CHAR = "nul_char"
LONE_SURROGATE = "lone_surrogate"
REJECT_REASONS = (BAD_JSON, NOT_OBJECT, BAD_PEER, MISSING_ID, BAD_ID, BAD_CHANNEL, NUL_CHAR, LONE_SURROGATE)

# Fixed value: the media type name that marks a photo message.
PHOTO_MEDIA = "MessageMediaPhoto"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A parsed variant keeps a number's value, not its text: 1.0 comes back as 1.
# So numbers are parsed as strings that begin with the two characters below, and
# a string's own U+0001 is followed by an "s", so that no string looks like one.
_NUMBER, _OWN = "\x01n", "\x01s"
# From where the last match ended: strings and whatever else is no number, then a number by the JSON grammar.
_TO_NUMBER = r'\G((?:[^"0-9-]++|"(?:[^"\\]++|\\.)*+")*+)(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+)'
# An escaped U+0001: its backslash follows an even number of others.
_ESCAPED = r"(?<!\\)((?:\\\\)*+)\\u0001"
_CONTROL = "\\u0001"


def numbers_as_text(json: Column) -> Column:
    """JSON text whose numbers are marked strings, so that a parse keeps them as written."""
    own = F.when(F.contains(json, F.lit(_CONTROL)), F.regexp_replace(json, _ESCAPED, r"$1\\u0001s")).otherwise(json)
    return F.regexp_replace(own, "(?s)" + _TO_NUMBER, r'$1"\\u0001n$2"')


def numbers_as_numbers(json: Column) -> Column:
    """The inverse of ``numbers_as_text`` on the text of a parsed document."""
    plain = _plain_numbers(json)
    return F.when(F.contains(plain, F.lit("\\u0001s")), _own_controls(plain)).otherwise(plain)


def _plain_numbers(json: Column) -> Column:
    return F.regexp_replace(json, r'"\\u0001n([^"]*+)"', "$1")


def _own_controls(json: Column) -> Column:
    return F.regexp_replace(json, _ESCAPED + "s", r"$1\\u0001")


def _as_written(marked: Column, value_type: Column) -> Column:
    """Text of a value from its marked text (see ``numbers_as_text``) and type name, a number's as written."""
    nested = F.contains(marked, F.lit(_CONTROL)) & value_type.rlike("^(OBJECT|ARRAY)")
    return (
        F.when(F.startswith(marked, F.lit(_NUMBER)), F.substring(marked, 3, 1 << 30))
        .when(F.contains(marked, F.lit(_OWN)), F.replace(marked, F.lit(_OWN), F.lit("\x01")))
        .when(nested, _own_controls(_plain_numbers(marked)))
        .otherwise(marked)
    )


def _is_number(marked: Column) -> Column:
    return F.startswith(marked, F.lit(_NUMBER))


def _with_once(df, values: dict[str, Column]):
    """``df`` with ``values`` as columns, each worked out once a row however often it is read.

    Emitted as a one-row generator, as the parse is: nothing is pushed below
    it, and the code that Spark makes of each step stays small enough for the
    JVM to compile (it interprets methods beyond 8,000 bytes).
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in values.items())))))


def parse_variant(value: Column | str) -> Column:
    """Lenient parse: NULL for text that is not one JSON value (incl. NaN, empty, text after the value).

    ``value`` has its numbers as marked text (see ``numbers_as_text``).
    ``try_parse_json`` stops at the end of the first value.  What may follow
    a value inside an array and inside an object has nothing but white space in
    common (after a comma, one asks for a value, the other for a name and a
    colon), so a text that parses within both is one value and nothing else.
    """
    value = _col(value)
    in_array = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))


def with_parsed(df, text_col: str, alias: str = "_doc", lenient: bool = True, keep=None):
    """Select ``keep`` columns plus ``text_col`` parsed into a variant column ``alias``.

    The parse is emitted as a one-element generator (``explode(array(..))``):
    filters on fields derived from the variant are then evaluated above the
    generator and cannot be pushed below it, which would inline (and repeat)
    the parse in every predicate.  Numbers are marked below it, once for both
    parses of a lenient one.
    """
    cols = list(keep) if keep is not None else [c for c in df.columns]
    marked = df.select(*cols, numbers_as_text(F.col(text_col)).alias("_marked"))
    parse = parse_variant("_marked") if lenient else F.parse_json("_marked")
    return marked.select(*cols, F.explode(F.array(parse)).alias(alias))


def variant_type(v: Column, path: str | None = None) -> Column:
    """Type name of the variant at ``path`` ('OBJECT<..>', 'BIGINT', 'VOID', ...).

    NULL when the path is absent, 'VOID' when it holds JSON null.
    """
    target = v if path is None else F.try_variant_get(v, path, "variant")
    return F.schema_of_variant(target)


def _is_object(v: Column, path: str = "$") -> Column:
    """True when the value at ``path`` is a JSON object.

    A cast to the empty struct succeeds exactly for objects and reads no
    fields, unlike building the value's full type name.
    """
    return F.try_variant_get(v, path, "struct<>").isNotNull()


def _is_present(v: Column, path: str) -> Column:
    """True when ``path`` exists (a JSON null counts as present)."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def _is_falsy(value_type: Column, marked: Column, text: Column) -> Column:
    """Python truthiness of a JSON value (absent counts as falsy).

    Falsy: absent, null, 0, 0.0, "", false, [], {}.
    """
    t, number = value_type, _is_number(marked)
    return (
        t.isNull()
        | (t == "VOID")
        | (number & (text.try_cast("double") == 0))
        | ((t == "STRING") & ~number & (marked == ""))
        | ((t == "BOOLEAN") & (marked == "false"))
        | (t == "ARRAY<VOID>")
        | (t == "OBJECT<>")
    )


def _is_integer_value(value_type: Column, marked: Column, text: Column) -> Column:
    """True when a JSON value can be stored in a BIGINT column.

    JSON integers and strings holding an integer are accepted (the database
    casts '7' to 7); decimals, booleans, arrays and objects are not.
    """
    whole = ~_is_number(marked) | text.rlike("^-?[0-9]+$")
    return (value_type == "STRING") & whole & text.try_cast("bigint").isNotNull()


# Fixed value: an escaped NUL character in JSON text, i.e. \u0000 preceded by
# an even number of backslashes (an odd number would make it literal text).
_NUL_ESCAPE = r"(^|[^\\])(\\\\)*\\u0000"


def has_nul_escape(text: Column) -> Column:
    """True when JSON text holds a NUL character (a cheap substring test gates the regex)."""
    return F.contains(text, F.lit("\\u0000")) & text.rlike(_NUL_ESCAPE)


# An escaped backslash or a whole escaped surrogate pair; any escaped surrogate.
_BACKSLASH_OR_PAIR = r"\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_SURROGATE = r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}"


def has_lone_surrogate(text: Column) -> Column:
    """True when JSON text holds half of a surrogate pair (a substring test and a regex gate the removal of whole pairs)."""
    return F.contains(text, F.lit("\\u")) & text.rlike(_SURROGATE) & F.regexp_replace(text, _BACKSLASH_OR_PAIR, " ").rlike(_SURROGATE)


# Columns of ``with_rule_values``, dropped again by whoever selects from it.
_ROOT, _PEER_THERE, _PEER, _ID, _CHANNEL = "_root_is_object", "_peer_there", "_peer_is_object", "_id", "_channel"


def with_rule_values(parsed, alias: str = "_doc"):
    """A parsed frame (see ``with_parsed``) with what the loader's rules ask of a file, each read once."""
    v = F.col(alias)
    values = {_ROOT: _is_object(v), _PEER_THERE: _is_present(v, "$.peer_id"), _PEER: _is_object(v, "$.peer_id")}
    for name, path in ((_ID, "$.id"), (_CHANNEL, "$.peer_id.channel_id")):
        values[f"{name}_type"] = variant_type(v, path)
        values[f"{name}_marked"] = F.try_variant_get(v, path, "string")
    read = _with_once(parsed, values)
    return _with_once(read, {f"{n}_text": _as_written(F.col(f"{n}_marked"), F.col(f"{n}_type")) for n in (_ID, _CHANNEL)})


def _value(name: str) -> tuple[Column, Column, Column]:
    return F.col(f"{name}_type"), F.col(f"{name}_marked"), F.col(f"{name}_text")


def reject_reason(v: Column, text: Column) -> Column:
    """Why a raw file cannot be loaded, or NULL when it can; over ``with_rule_values``.

    ``v`` is the file's parsed variant (each file is parsed once) and ``text``
    its JSON text.
    Precedence follows the loader: undecodable JSON, then a root or
    ``peer_id`` that is not an object, then a falsy ``id``, then values the
    raw table's BIGINT columns refuse, then NUL characters and halves of
    surrogate pairs (rejected by the JSON column type).
    """
    channel_t = F.col(f"{_CHANNEL}_type")
    channel_ok = channel_t.isNull() | (channel_t == "VOID") | _is_integer_value(*_value(_CHANNEL))
    return (
        F.when(v.isNull(), F.lit(BAD_JSON))
        .when(~F.col(_ROOT), F.lit(NOT_OBJECT))
        .when(F.col(_PEER_THERE) & ~F.col(_PEER), F.lit(BAD_PEER))
        .when(_is_falsy(*_value(_ID)), F.lit(MISSING_ID))
        .when(~_is_integer_value(*_value(_ID)), F.lit(BAD_ID))
        .when(~channel_ok, F.lit(BAD_CHANNEL))
        .when(has_nul_escape(text), F.lit(NUL_CHAR))
        .when(has_lone_surrogate(text), F.lit(LONE_SURROGATE))
    )


def normalized_json(v: Column) -> Column:
    """Re-serialised JSON text of a parsed file: numbers as written, duplicate keys resolved last-wins.

    Needs ``spark.sql.variant.allowDuplicateKeys=true`` (set by the ingest
    operators), otherwise a file with a repeated key parses to NULL.
    """
    return numbers_as_numbers(v.cast("string"))


def id_field() -> Column:
    """The message id, over ``with_rule_values``."""
    return F.col(f"{_ID}_text").try_cast("bigint")


def channel_field() -> Column:
    """The channel id, over ``with_rule_values``."""
    return F.col(f"{_CHANNEL}_text").try_cast("bigint")


# Fixed value: values in one step whose code the JVM still compiles (see ``_with_once``).
_AT_ONCE = 2


def with_json_texts(parsed, paths: dict[str, str], alias: str = "_doc"):
    """``->>``: a column of text for each path of a parsed document, a number's as written; NULL for absent or JSON null."""
    v = F.col(alias)
    others = [c for c in parsed.columns if c != alias]
    read = _with_once(parsed, {f"_{n}_marked": F.variant_get(v, path, "string") for n, path in paths.items()})
    names = list(paths)
    for k in range(0, len(names), _AT_ONCE):
        some = names[k : k + _AT_ONCE]
        read = _with_once(read, {n: _as_written(F.col(f"_{n}_marked"), variant_type(v, paths[n])) for n in some})
    return read.select(*others, *names)


def strict_cast(text: Column, type_name: str) -> Column:
    """Cast that fails on text that is no such value, whatever the session's ANSI setting; NULL stays NULL."""
    failed = F.raise_error(F.concat(F.lit(f"not a {type_name}: "), text)).cast(type_name)
    return F.coalesce(text.try_cast(type_name), F.when(text.isNotNull(), failed))

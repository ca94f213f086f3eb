"""Labels, fingerprints, redaction, identifiers and binary literals."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from exactsync.errors import SyncError

REDACTED = "[REDACTED]"
_JSON_STRING = re.compile(r'"((?:[^"\\]|\\.)*)"(\s*:)?', re.DOTALL)
_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}\[\],:]|[^\s{}\[\],:"]+', re.DOTALL)
_SEPARATOR = "\x1f"
_NULL_MARK = "\x1e"


def quoted(name: str) -> str:
    if not name or "\x00" in name:
        raise SyncError.config("a name has at least one character and no NUL")
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def string_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def check_label_prefix(prefix: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]{1,40}", prefix, flags=re.ASCII):
        raise SyncError.config("label prefix must be 1..40 ASCII letters, digits or underscores")
    return prefix


def batch_label(prefix: str, run_id: Column, batch_id: Column) -> Column:
    """``prefix_runid_batch``: the name under which a batch is committed at most once."""
    compact = F.regexp_replace(run_id, "-", "")
    return F.concat_ws("_", F.lit(check_label_prefix(prefix)), compact, batch_id.cast("string"))


def fingerprint(*fields: Column) -> Column:
    """SHA-256 over the fields of a request; NULL and empty stay different."""
    marked = [F.coalesce(f.cast("string"), F.lit(_NULL_MARK)) for f in fields]
    return F.sha2(F.concat_ws(_SEPARATOR, *marked), 256)


def redact_json(text: str | None) -> str | None:
    """JSON text with the value of every "password" member replaced, whatever it is and however deep it stands.

    The rest of the text stays as it is. A value that does not end takes the rest of the text with it.
    """
    if text is None:
        return None
    out, done, at = [], 0, 0
    while found := _JSON_STRING.search(text, at):
        at = found.end()
        if not found[2] or _member_name(found[1]) != "password":
            continue
        depth, end = 0, len(text)
        for token in _JSON_TOKEN.finditer(text, at):
            depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(token[0], 0)
            if depth <= 0:
                end = token.end()
                break
        out += [text[done : found.start()], f'"password":"{REDACTED}"']
        done = at = end
    return "".join(out) + text[done:]


def _member_name(inner: str) -> str | None:
    """A member's name from what stands between its quotes."""
    if "\\" not in inner:
        return inner
    try:
        return json.loads(f'"{inner}"', strict=False)
    except ValueError:
        return None


def redact_config(config: Column) -> Column:
    """Configuration JSON with every password replaced, at any depth; configurations are few and small."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return texts.map(redact_json)

    return redact(config)


def decode_base64(text: Column) -> Column:
    """Bytes of base64 text; NULL where it is malformed."""
    return F.try_to_binary(text, F.lit("base64"))


def encode_base64(value: Column) -> Column:
    """Base64 on one line, whatever the session says about line breaks."""
    return F.replace(F.base64(value), F.lit("\r\n"), F.lit(""))


def redacted(config):
    """The same for a configuration still in memory."""
    if isinstance(config, dict):
        return {k: REDACTED if k == "password" else redacted(v) for k, v in config.items()}
    if isinstance(config, (list, tuple)):
        return [redacted(v) for v in config]
    return config

"""Chat formatting: records of unlike layouts into one canonical template.

A record's layout is told by a fingerprint, the SHA-256 of its sorted nested
field paths (those under columns that are not null in the row). The fingerprint
selects a declarative mapping to canonical turns (role, text). Turns become one
string::

    <turn role="ROLE">TEXT</turn>\\n

in which ``&``, ``<`` and, in roles, ``"`` are escaped as entities, so that no text
can end a turn or open one, and reading back gives each text exactly. The loss
mask is a list of (start, length) in code points that covers the escaped text of
assistant turns only.

Defined results: null text or role is empty; a record without turns formats to an
empty string; a layout whose fingerprint is unknown keeps its row with null turns;
repeated rows are formatted each; an empty table gives no rows; columns outside a
layout, also of clashing names, change no fingerprint when their paths are not
registered as layout fields. A conversation is one string, so it must fit a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.llm.common import let

END = "</turn>\n"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}    # names that layouts use


@dataclass(frozen=True)
class Layout:
    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(column: str, role: str, text: str) -> Callable[[], Column]:
    def renamed(r: Column) -> Column:
        out = r
        for old, new in ROLES.items():
            out = F.when(r == old, F.lit(new)).otherwise(out) if out is r else F.when(r == old, F.lit(new)).otherwise(out)
        return out

    return lambda: F.transform(F.col(column), lambda x: _turn(renamed(x[role]) if role == "from" else x[role], x[text]))


def _said(*pairs: tuple[str, tuple[str, ...]]) -> Callable[[], Column]:
    """Turns of (role, columns); several columns of a turn are joined by blank lines."""
    return lambda: F.array(*[_turn(F.lit(role), F.concat_ws("\n\n", *[F.col(c) for c in columns])) for role, columns in pairs])


LAYOUTS = [
    Layout("messages", ("messages[].content", "messages[].role"), _listed("messages", "role", "content")),
    Layout("from_value", ("dialog[].from", "dialog[].value"), _listed("dialog", "from", "value")),
    Layout("prompt_response", ("prompt", "response"), _said(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response", ("prompt", "response", "system"),
           _said(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", ("instruction", "output"), _said(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", ("input", "instruction", "output"), _said(("user", ("instruction", "input")), ("assistant", ("output",)))),
]


def field_paths(kind: T.DataType, path: str = "") -> list[str]:
    """Nested paths of the leaves; ``[]`` steps into an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, path + "[]")
    return [path]


def fingerprint(paths: tuple[str, ...] | list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def row_fingerprint(df: DataFrame, layouts: list[Layout]) -> Column:
    """The fingerprint of each row's layout fields, as a column."""
    known = {p for x in layouts for p in x.paths}
    tops: dict[str, list[str]] = {}
    for f in df.schema.fields:
        for p in field_paths(f.dataType, f.name):
            if p in known:
                tops.setdefault(f.name, []).append(p)
    parts = [F.when(F.col(f"`{c}`").isNotNull(), F.array(*[F.lit(p) for p in ps])) for c, ps in tops.items()]
    empty = F.array().cast("array<string>")
    paths = F.flatten(F.array(*[F.coalesce(p, empty) for p in parts])) if parts else empty
    return F.sha2(F.array_join(F.sort_array(paths), "\n"), 256)


def canonical(df: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` (null: unknown) and ``turns``."""
    have = {p for f in df.schema.fields for p in field_paths(f.dataType, f.name)}
    usable = [x for x in layouts if set(x.paths) <= have]
    df = df.withColumn("_fingerprint", row_fingerprint(df, layouts))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for x in usable:
        hit = F.col("_fingerprint") == fingerprint(x.paths)
        layout, turns = F.when(hit, F.lit(x.name)).otherwise(layout), F.when(hit, x.turns()).otherwise(turns)
    return df.withColumn("layout", layout).withColumn("turns", turns).drop("_fingerprint")


def _escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit('"'), F.lit("&quot;")) if role else out


def _unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("&quot;"), F.lit('"')), F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def format_chats(df: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``df`` with ``layout``, ``formatted`` and ``loss_spans`` (start and length in
    code points from 0)."""
    df = canonical(df, layouts)
    marked = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit('<turn role="'), _escape(t["role"], True), F.lit('">')).alias("head"), _escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("learn")))

    def spans(parts: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("got"))

        def step(acc: Column, p: Column) -> Column:
            first, n = acc["at"] + F.length(p["head"]), F.length(p["body"])
            span = F.array(F.struct(first.cast("long").alias("start"), n.cast("long").alias("length")))
            return F.struct((first + n + len(END)).cast("long").alias("at"),
                            F.when(p["learn"], F.concat(acc["got"], span)).otherwise(acc["got"]).alias("got"))

        return F.aggregate(parts, start, step, lambda acc: acc["got"])

    done = let(marked, lambda parts: F.struct(
        F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        spans(parts).alias("loss_spans")))
    return df.withColumn("_done", F.when(F.col("turns").isNotNull(), done)).select(
        *[c for c in df.columns if c != "turns"], "_done.formatted", "_done.loss_spans")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string."""
    parts = F.split(formatted, END, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        _unescape(F.regexp_extract(p, r'(?s)\A<turn role="([^"]*)">', 1)).alias("role"),
        _unescape(F.regexp_replace(p, r'(?s)\A<turn role="[^"]*">', "")).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: _unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")


def records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one record a conversation, in the
    layout that its shape has where data are usually found: a lone user and
    assistant pair as prompt and response, other conversations as messages.
    Rows of one turn number come in the order of role and text."""
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    grouped = rows.groupBy("conv_id").agg(turns.alias("t"))
    pair = F.transform("t", lambda x: x["role"]) == F.array(F.lit("user"), F.lit("assistant"))
    return grouped.select(
        "conv_id", F.when(~pair, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("messages"),
        F.when(pair, F.col("t")[0]["text"]).alias("prompt"), F.when(pair, F.col("t")[1]["text"]).alias("response"))


def digests(done: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted strings and their masks."""
    back = done.select("conv_id", "formatted", "loss_spans", read_back(F.col("formatted")).alias("turns"))
    back = back.withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;')) + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + 22) AS k
  FROM c GROUP BY 1)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, k::BIGINT AS formatted_chars FROM g
"""

"""Chat formatting: records of any known layout to canonical turns, to one templated string, and back.

Records are JSON strings. A record's schema, the names of its fields at any depth, is hashed to a fingerprint. Those of its field paths
that some mapping knows are hashed as well, and by that hash a declarative mapping is selected, which says where the turns are; a record
that holds more known fields than any mapping takes the mapping with the most fields that it has. All steps are DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What marks turns in the template. No escaped text holds "<" or "[", so no text holds a mark or another template's control strings.
START, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Characters and what stands for them in texts; the first is undone last.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
TURNS = "array<struct<role:string,text:string>>"
#: Else a record with a string of more than 20 million characters is none for the JSON reader.
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


def _json(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, _ANY_LENGTH)


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


#: Names of roles in some layouts, and what they are called in canonical turns.
ALIASES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. ``turns``: the list's name and its role and text fields; else ``fields``: (field, role) in order.
    ``roles`` renames roles, whatever their case; others, and all if there are none, stay as they are."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def expression(self, record: Column) -> Column:
        """The turns of a parsed record. Text is a string, or a list of parts with a ``text`` each, which are put together; else its JSON."""
        if self.turns:
            top, role, text = self.turns
            items = F.try_variant_get(record, f"$.{top}", "array<variant>")
            own = lambda t: F.coalesce(F.try_variant_get(t, f"$.{role}", "string"), F.lit(""))
            if self.roles:
                names = F.create_map(*[F.lit(x) for pair in self.roles for x in pair])
                as_is, own = own, lambda t: F.coalesce(F.try_element_at(names, F.lower(as_is(t))), as_is(t))
            out = F.transform(items, lambda t: F.struct(own(t).alias("role"), F.coalesce(_text(t, text), F.lit("")).alias("text")))
        else:
            present = F.array(*[F.struct(F.lit(role).alias("role"), _text(record, f).alias("text")) for f, role in self.fields])
            out = F.filter(present, lambda t: t["text"].isNotNull() & ((t["role"] != "system") | (t["text"] != "")))
        return out.cast(TURNS)

    def of_long_record(self, record: Column) -> Column:
        """The same from the JSON string of a record that is too long to be parsed to a variant, by schemas of just what the mapping reads."""
        if self.turns:
            top, role, text = self.turns
            items = _json(record, f"struct<`{top}`:array<map<string,string>>>")[top]
            parts = _json(record, f"struct<`{top}`:array<struct<`{text}`:array<struct<text:string>>>>>")[top]
            names = F.create_map(*[F.lit(x) for pair in self.roles or (("", ""),) for x in pair])
            own = lambda t: F.coalesce(F.try_element_at(names, F.lower(t[role])), t[role], F.lit(""))
            return F.transform(items, lambda t, i: F.struct(own(t).alias("role"), F.coalesce(_joined(F.get(parts, i)[text]), t[text], F.lit("")).alias("text"))).cast(TURNS)
        values = _json(record, "map<string,string>")
        whole = lambda f: F.coalesce(_joined(_json(record, f"struct<`{f}`:array<struct<text:string>>>")[f]), values[f])
        present = F.array(*[F.struct(F.lit(role).alias("role"), whole(f).alias("text")) for f, role in self.fields])
        return F.when(values.isNotNull(), F.filter(present, lambda t: t["text"].isNotNull() & ((t["role"] != "system") | (t["text"] != "")))).cast(TURNS)


def _joined(parts: Column) -> Column:
    """The texts of a list of parts put together; null if there are none."""
    whole = F.exists(parts, lambda p: p["text"].isNotNull())
    return F.when(whole, F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))


def _text(record: Column, field: str) -> Column:
    return F.coalesce(_joined(F.try_variant_get(record, f"$.{field}", "array<struct<text:string>>")), F.try_variant_get(record, f"$.{field}", "string"))


#: The layouts known so far.
MAPPINGS = (
    Mapping("messages", ("messages", "messages.content", "messages.role"), turns=("messages", "role", "content"), roles=ALIASES),
    Mapping("conversations", ("conversations", "conversations.from", "conversations.value"), turns=("conversations", "from", "value"), roles=ALIASES),
    Mapping("turns", ("turns", "turns.role", "turns.text"), turns=("turns", "role", "text"), roles=ALIASES),
    Mapping("instruction", ("input", "instruction", "output"), fields=(("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Mapping("instruction-short", ("instruction", "output"), fields=(("instruction", "user"), ("output", "assistant"))),
    Mapping("prompt", ("completion", "prompt"), fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("prompt-response", ("prompt", "response"), fields=(("prompt", "user"), ("response", "assistant"))),
    Mapping("question", ("answer", "question", "system"), fields=(("system", "system"), ("question", "user"), ("answer", "assistant"))),
)


#: The same layouts with roles as they stand in the record.
AS_THEY_STAND = tuple(replace(m, roles=()) for m in MAPPINGS)


def field_paths(record: Column) -> Column:
    """Sorted field paths of a JSON record to the depth at which mappings find turns; the fields of a list are those of any of its items."""
    top = _json(record, "map<string,string>")

    def inner(pair: Column) -> Column:
        value = F.trim(pair["value"])
        items = F.when(value.startswith("["), _json(value, "array<map<string,string>>")).when(value.startswith("{"), F.array(_json(value, "map<string,string>")))
        keys = F.array_distinct(F.flatten(F.transform(F.filter(items, lambda m: m.isNotNull()), lambda m: F.map_keys(m))))
        return F.concat(F.array(pair["key"]), F.transform(F.coalesce(keys, F.array().cast("array<string>")), lambda k: F.concat(pair["key"], F.lit("."), k)))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.map_entries(top), inner))))


def fingerprint(record: Column) -> Column:
    """Hash of a record's schema: its field names at any depth and which of them are lists, but not the kinds of single values; null for
    what is no JSON."""
    kinds = F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), r"\b(STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)", "value")
    return F.xxhash64(kinds)


def selector(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns``, in place of columns of these names. Null, broken and unknown records: layout null
    and no turns. Fields that no mapping knows don't matter. A record of a known layout that can't be read is an error, whatever its length;
    one that is too long for a variant has no fingerprint."""
    added = ("fingerprint", "layout", "turns")
    known = F.array(*[F.lit(p) for p in sorted({p for m in mappings for p in m.paths})])
    rows = records.select(F.struct(*[records[c] for c in records.columns if c not in added]).alias("row"), records[record].alias("record"), F.try_parse_json(records[record]).alias("parsed"))
    rows = rows.withColumn("paths", F.array_intersect(field_paths(F.col("record")), known))
    which = None
    for m in mappings:
        # a literal, so that Catalyst folds the known layout's hash
        same = selector(F.array_sort("paths")) == selector(F.array(*[F.lit(p) for p in sorted(m.paths)]))
        which = F.when(same, F.lit(m.name)) if which is None else which.when(same, F.lit(m.name))
    for m in sorted(mappings, key=lambda m: -len(m.paths)):
        which = which.when(F.size(F.array_except(F.array(*[F.lit(p) for p in m.paths]), F.col("paths"))) == 0, F.lit(m.name))
    rows = rows.withColumn("layout", which)
    turns = None
    for m in mappings:
        own = F.col("layout") == m.name
        lost = F.raise_error(F.concat(F.lit(f"no turns in a record of layout {m.name}, of characters: "), F.char_length("record").cast("string"))).cast(TURNS)
        found = F.when(F.col("parsed").isNotNull(), m.expression(F.col("parsed"))).otherwise(F.coalesce(m.of_long_record(F.col("record")), lost))
        turns = F.when(own, found) if turns is None else turns.when(own, found)
    return rows.select("row.*", fingerprint(F.col("record")).alias("fingerprint"), "layout", F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def _marked(turn: Column) -> Column:
    return F.concat(F.lit(START), escape(F.coalesce(turn["role"], F.lit(""))), F.lit(MIDDLE), escape(F.coalesce(turn["text"], F.lit(""))), F.lit(END))


def render(turns: Column) -> Column:
    """The formatted string of a conversation."""
    return F.array_join(F.transform(turns, _marked), "")


def loss_spans(turns: Column) -> Column:
    """``(start, length)`` in characters of each assistant text within the formatted string, 0-based."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        head = F.lit(len(START) + len(MIDDLE)) + F.char_length(escape(F.coalesce(turn["role"], F.lit(""))))
        size = F.char_length(escape(F.coalesce(turn["text"], F.lit(""))))
        own = F.struct((acc["at"] + head).cast("long").alias("start"), size.cast("long").alias("length"))
        spans = F.when(turn["role"] == "assistant", F.array_append(acc["spans"], own)).otherwise(acc["spans"])
        return F.struct((acc["at"] + head + size + F.lit(len(END))).cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, step)["spans"]


def parse(formatted: Column) -> Column:
    """Turns read back from the formatted string."""
    parts = F.filter(F.split(formatted, r"\Q" + START + r"\E", -1), lambda p: p != "")
    body = lambda p: F.substring_index(p, END, 1)  # noqa: E731  escaped texts can't hold END
    return F.transform(
        parts,
        lambda p: F.struct(unescape(F.substring_index(body(p), MIDDLE, 1)).alias("role"), unescape(F.substring_index(body(p), MIDDLE, -1)).alias("text")),
    )


def format_chats(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``formatted`` (the templated string) and ``loss_spans`` (what the loss covers) to records of known layouts."""
    return canonical_turns(records, record, mappings).withColumn("formatted", render(F.col("turns"))).withColumn("loss_spans", loss_spans(F.col("turns")))


def conversation_records(rows: DataFrame) -> DataFrame:
    """``(conv_id, record)``: the turns of each conversation as one JSON record: a user's turn and an assistant's as ``prompt`` and ``response``,
    the same after a system's turn with a text as ``system``, ``question`` and ``answer``, all others as ``messages``. Read with
    ``AS_THEY_STAND``, records give back all turns with their own roles.

    Rows are ordered by turn (null first), then role and text, so ties have one result. Null role or text: empty. Rows without
    conv_id form one conversation. A conversation is one record of the output, so its rows meet in one row here as well.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"))
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    roles = F.array_join(F.transform("ts", lambda t: t["role"]), "\n")
    said = lambda i: F.col("ts")[i]["content"]
    record = (
        F.when((F.size("ts") == 2) & (roles == "user\nassistant"), F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("response"))))
        .when((F.size("ts") == 3) & (roles == "system\nuser\nassistant") & (said(0) != ""), F.to_json(F.struct(said(0).alias("system"), said(1).alias("question"), said(2).alias("answer"))))
        .otherwise(F.to_json(F.struct(F.col("ts").alias("messages"))))
    )
    return rows.groupBy("conv_id").agg(ordered.alias("ts")).select("conv_id", record.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what is read from ``formatted`` and ``loss_spans``: counts and hashes of turns and of the text under the loss."""
    turns = formatted.withColumn("back", parse(F.col("formatted"))).withColumn(
        "under_loss", F.array_join(F.transform(F.col("loss_spans"), lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))), "")
    )
    return turns.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("under_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("under_loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )

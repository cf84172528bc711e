r"""Chat formatting by schema fingerprints.

A record's nested field paths (names, with [] for list items) are hashed, less
those of no layout that it has whole; the fingerprint alone selects a declarative
mapping that says where the turns are. A table is recognised by its schema, JSON
records, whose layouts may differ from row to row, one by one. All become
canonical turns (role, text).

Template: every turn is written as  <|start|>ROLE<|sep|>TEXT<|end|>\n . Control
strings inside roles and texts are broken by a backslash after their first
character and backslashes are doubled, so the output can be read back exactly:
no control string of CONTROL survives inside a text. The loss mask holds the
spans (code points in the output) of the assistant's texts.

Defined results
* null text or role: empty. Turns are ordered by turn, then role, then text;
  null turns come first; repeated rows are turns of their own.
* null conversation identifiers form one conversation. An empty table gives an
  empty result. Very long texts are formatted whole.
* a JSON record that has no layout's fields, that is no JSON or is nested too
  deeply: null turns. An empty list of turns is a conversation without turns.
  Unpaired surrogates become U+FFFD.
* records and tables are mapped by the fields that a layout names (the one with
  the most, if several fit); other fields and columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"

#: Control strings of common chat templates; none may appear inside a text.
CONTROL = (START, SEP, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")

TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))

#: Layouts: the field paths of a record, and where its turns are. "each": a list of turns with the fields of role
#: and text. "say": a role and the fields whose non-empty values, joined by a blank line, are its text.
LAYOUTS = {
    "messages": {"paths": ("messages[].role", "messages[].content"), "each": ("messages", "role", "content")},
    "conversations": {"paths": ("conversations[].from", "conversations[].value"), "each": ("conversations", "from", "value")},
    "turns": {"paths": ("turns[].role", "turns[].text"), "each": ("turns", "role", "text")},
    "prompt": {"paths": ("prompt", "response"), "say": (("user", ("prompt",)), ("assistant", ("response",)))},
    "completion": {"paths": ("prompt", "completion"), "say": (("user", ("prompt",)), ("assistant", ("completion",)))},
    "instruction": {"paths": ("instruction", "output"), "say": (("user", ("instruction",)), ("assistant", ("output",)))},
    "instruction_input": {
        "paths": ("instruction", "input", "output"),
        "say": (("user", ("instruction", "input")), ("assistant", ("output",))),
    },
    "system_prompt": {
        "paths": ("system", "prompt", "response"),
        "say": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    },
    "rows": {"paths": ("conv_id", "turn", "role", "text"), "rows": ("conv_id", "turn", "role", "text")},
}

#: Other names of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    """The hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def known_paths(paths) -> set[str]:
    """Of a record's nested field paths, those of the layouts that it has whole; the rest says nothing about its turns."""
    paths = set(paths)
    return {p for x in LAYOUTS.values() if paths.issuperset(x["paths"]) for p in x["paths"]}


def _mappings() -> dict[str, dict]:
    """The layout of every schema, by its fingerprint: records may have several layouts' fields, of which the one with the most counts."""
    out: dict[str, dict] = {}
    for n in range(1, len(LAYOUTS) + 1):
        for some in itertools.combinations(LAYOUTS.values(), n):
            whole = known_paths(p for x in some for p in x["paths"])
            out.setdefault(fingerprint(whole), max((x for x in LAYOUTS.values() if whole.issuperset(x["paths"])), key=lambda x: len(x["paths"])))
    return out


MAPPINGS = _mappings()


def mapping_of(paths) -> dict | None:
    """The layout that the fingerprint of these paths selects."""
    return MAPPINGS.get(fingerprint(known_paths(paths)))


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return schema_paths(kind.elementType, f"{at}[]") if isinstance(kind, T.ArrayType) else [at]


def value_paths(value, at: str = "") -> list[str]:
    """Nested field paths of a JSON value; an empty list has the paths of no item."""
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)]
    return [p for v in value for p in value_paths(v, f"{at}[]")] if isinstance(value, list) else [at]


def _canonical(record, mapping: dict) -> list[tuple[str, str]]:
    if "each" in mapping:
        where, role, text = mapping["each"]
        return [(ROLES.get(x.get(role), x.get(role)) or "", _string(x.get(text))) for x in record[where] or ()]
    return [(role, "\n\n".join(v for f in fields if (v := _string(record.get(f))))) for role, fields in mapping["say"]]


def _string(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def json_turns(record: str | None) -> list[tuple[str, str]] | None:
    """Canonical turns of one JSON record; null if it has no layout's fields."""
    try:
        value = json.loads(record)
        if not isinstance(value, dict):
            return None
        mapping = mapping_of([*value_paths(value), *_item_paths(value)])
        if mapping is None or "rows" in mapping or not _plain(value, mapping):
            return None
        return [(whole(role), whole(text)) for role, text in _canonical(value, mapping)]
    except (TypeError, ValueError, RecursionError):  # no JSON, or nested too deeply to be read
        return None


def whole(text: str) -> str:
    """A text with U+FFFD for each half of a surrogate pair, which no encoding can hold."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _item_paths(record: dict) -> list[str]:
    """The paths that items of a layout's list would have, where the list is empty."""
    return [p for x in LAYOUTS.values() if "each" in x and record.get(x["each"][0]) == [] for p in x["paths"]]


def _plain(record: dict, mapping: dict) -> bool:
    """Whether the items of the layout's list are records with plain roles."""
    if "each" not in mapping:
        return True
    where, role, _ = mapping["each"]
    return all(isinstance(x, dict) and not isinstance(x.get(role), dict | list) for x in record[where])


def canonical_turns(df: DataFrame, id_col: str, json_col: str | None = None) -> DataFrame:
    """id_col and turns (array of role and text): from JSON records in json_col, or from the table's own columns.

    A table is of the layout that the fingerprint of its schema selects.
    """
    if json_col is not None:
        turns = F.udf(json_turns, TURNS, useArrow=True)
        return df.select(F.col(id_col), turns(F.col(json_col)).alias("turns"))
    paths = schema_paths(df.schema)
    mapping = mapping_of(paths)
    if mapping is None:
        raise ValueError("no mapping has these fields: " + ", ".join(sorted(paths)))
    empty = F.lit("")
    if "rows" in mapping:
        conv, turn, role, text = mapping["rows"]
        one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))
        grouped = df.groupBy(F.col(conv).alias(id_col)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
        return grouped.select(id_col, F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    if "each" in mapping:
        where, role, text = mapping["each"]
        names = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
        said = lambda x: F.struct(
            F.coalesce(names[x[role]], x[role], empty).alias("role"), F.coalesce(x[text].cast("string"), empty).alias("text")
        )
        return df.select(id_col, F.transform(F.coalesce(where, F.array().cast(df.schema[where].dataType)), said).alias("turns"))
    said = [
        F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *[F.nullif(F.col(f).cast("string"), empty) for f in fields]).alias("text"))
        for role, fields in mapping["say"]
    ]
    return df.select(id_col, F.array(*said).alias("turns"))


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}\n", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the loss mask: spans of the assistant's (escaped) texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns that format_turns() was given."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


def format_chat(turns: DataFrame, id_col: str) -> DataFrame:
    """id_col, formatted, loss_spans (start and end, code points) from canonical turns; null turns give null."""
    kind = turns.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = [], []
            for value in batch.column(1):
                said = value.as_py()
                text, spans = (None, None) if said is None else format_turns([(x["role"] or "", x["text"] or "") for x in said])
                texts.append(text)
                masks.append(None if spans is None else [{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(masks, span)], ["_id", "formatted", "loss_spans"])

    out = turns.select(F.col(id_col).alias("_id"), "turns").mapInArrow(run, f"_id {kind}, formatted string, loss_spans array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("_id", id_col)


def read_digests(chat: DataFrame, id_col: str) -> DataFrame:
    """What the formatted texts say, read back from them: turns, digests of the turns and of the text under the loss mask."""
    kind = chat.schema[id_col].dataType.simpleString()
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                formatted = text.as_py() or ""
                turns = read_back(formatted)
                loss = "".join(unescape(formatted[x["start"] : x["end"]]) for x in spans.as_py() or ())
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", *names])

    schema = f"_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return chat.select(F.col(id_col).alias("_id"), "formatted", "loss_spans").mapInArrow(run, schema).withColumnRenamed("_id", id_col)

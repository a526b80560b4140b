r"""Chat formatting: schema fingerprints select declarative mappings into canonical turns.

A record is one JSON text of any layout.  Its nested field paths (names, nesting and array
levels, not scalar types) are spelled out in name order and hashed; the hash picks a
``Layout``, which says declaratively where the turns are and what roles mean.  Every layout
lists its skeletons, so a record with or without an optional field has its own fingerprint.
This part runs on Spark's variant functions.

``format_turns`` writes turns with a template.  Control strings inside texts are escaped by
one backslash after their first character; a control string that already carries k
backslashes there gets k + 1, so the escape is reversible and a formatted text holds a
control string only where the template put it.  The loss mask is a list of code point spans
of the formatted text, one per assistant turn, without the marks.  ``read_back`` needs
nothing but the formatted text and the mask.

Defined cases: a text that is not JSON, or whose fingerprint no layout has, keeps its row
with null layout, turns, formatted text and mask (``fingerprint`` says which; null for
non-JSON); a null or missing text field is empty; a null role is the empty role; an empty
list of turns gives an empty formatted text and mask; an optional text that is null is no
turn; repeated records are formatted each; an empty table gives an empty result.  Extra
columns pass through; names the operator adds must be free and raise otherwise.
One conversation is one formatted value, so it has to fit in a task, like a document.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ROWS = 1024


# ------------------------------------------------------------------ fingerprints
def shape(skeleton) -> str:
    """Field paths of a skeleton (nested dicts, one-element or empty lists, None for scalars) as one string.

    ``{`` opens the fields of an object, ``[`` the elements of a list, ``>`` closes either.
    """
    if isinstance(skeleton, dict):
        return "{" + ",".join(k + shape(v) for k, v in sorted(skeleton.items())) + ">"
    if isinstance(skeleton, list):
        return "[" + (shape(skeleton[0]) if skeleton else "") + ">"
    return ""


def shape_of(variant):
    """The same string for a variant column."""
    s = F.schema_of_variant(variant)
    scalar = r"\b(?:STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL\(\d+,\d+\))(?=[,>]|$)"
    for pattern, to in ((f"(?<=: ){scalar}", ""), (f"(?<=ARRAY<){scalar}", ""), (r"OBJECT<", "{"), (r"ARRAY<", "["), (", ", ","), (": ", "")):
        s = F.regexp_replace(s, pattern, to)
    return s


@dataclass(frozen=True)
class Layout:
    """Where a family of records keeps its turns.

    ``items`` is the path of a turn list with ``role`` and ``text`` paths inside an element;
    otherwise ``fixed`` lists (role, path, optional) in order.  ``roles`` renames roles.
    """

    name: str
    skeletons: tuple
    items: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple = ()
    roles: dict = field(default_factory=dict)

    def fingerprints(self) -> list[str]:
        return [hashlib.md5(shape(s).encode()).hexdigest() for s in self.skeletons]

    def turns(self, v: str):
        """Canonical turns of a variant column of this layout."""
        if self.items:
            nest = lambda p: "struct<" + p.replace(".", ":struct<") + ":string" + ">" * (p.count(".") + 1)
            a, b = self.role.split("."), self.text.split(".")
            if a[0] == b[0]:
                raise ValueError("role and text need separate branches of an element")
            kind = f"array<struct<{nest(self.role)[7:-1]},{nest(self.text)[7:-1]}>>"
            name = "coalesce(x.{}, '')".format(".".join(a))
            if self.roles:
                name = "case {} {} else {} end".format(name, " ".join(f"when '{k}' then '{r}'" for k, r in self.roles.items()), name)
            return F.expr(f"transform(variant_get({v}, '$.{self.items}', '{kind}'), x -> "
                          f"struct({name} as role, coalesce(x.{'.'.join(b)}, '') as text))")
        parts = []
        for role, path, optional in self.fixed:
            text = f"variant_get({v}, '$.{path}', 'string')"
            one = f"array(struct('{role}' as role, coalesce({text}, '') as text))"
            parts.append(f"if({text} is null, slice({one}, 1, 0), {one})" if optional else one)
        return F.expr(f"concat({', '.join(parts)})")


#: Layouts of common public instruction and chat collections.
LAYOUTS = (
    Layout("messages", ({"messages": [{"role": None, "content": None}]}, {"messages": []}), "messages", "role", "content"),
    Layout("conversations", ({"conversations": [{"from": None, "value": None}]}, {"id": None, "conversations": [{"from": None, "value": None}]},
                             {"conversations": []}), "conversations", "from", "value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt", ({"prompt": None, "completion": None}, {"prompt": None, "completion": None, "system": None}),
           fixed=(("system", "system", True), ("user", "prompt", False), ("assistant", "completion", False))),
    Layout("instruction", ({"instruction": None, "output": None}, {"system": None, "instruction": None, "output": None}),
           fixed=(("system", "system", True), ("user", "instruction", False), ("assistant", "output", False))),
    Layout("dialogue", ({"dialogue": {"turns": [{"speaker": {"name": None}, "utterance": {"text": None}}]}}, {"dialogue": {"turns": []}}),
           "dialogue.turns", "speaker.name", "utterance.text"),
)


def _free(df: DataFrame, *names: str) -> None:
    taken = {c.lower() for c in df.columns} & set(names)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the way: rename them first")


def canonical_turns(records: DataFrame, record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns`` (array of role, text) to a table of JSON records."""
    _free(records, "fingerprint", "layout", "turns", "__v")
    known = [x for y in layouts for x in y.fingerprints()]
    if len(set(known)) < len(known):
        raise ValueError("two layouts share a fingerprint")
    df = records.withColumn("__v", F.try_parse_json(F.col(record)))
    df = df.withColumn("fingerprint", F.when(F.col("__v").isNotNull(), F.md5(shape_of("__v"))))
    name = turns = None
    for y in layouts:
        mine = F.col("fingerprint").isin(y.fingerprints())
        name = (F.when if name is None else name.when)(mine, y.name)
        turns = (F.when if turns is None else turns.when)(mine, y.turns("__v"))
    return df.withColumns({"layout": name, "turns": turns}).drop("__v")


# ------------------------------------------------------------------ template
@dataclass(frozen=True)
class Template:
    """Marks around the turns of a conversation; other roles stand, quoted, on a line inside the ``other`` marks."""

    user: tuple = ("[INST] ", " [/INST]")
    assistant: tuple = ("<s>", "</s>")
    other: tuple = ("<<SYS>>", "<</SYS>>")
    control: tuple = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")

    def __post_init__(self):
        """Refuses templates whose texts could not be read back."""
        for pair in (self.user, self.assistant, self.other):
            for mark in pair:
                if sum(c in mark for c in self.control) < 1 or "\\" in mark:
                    raise ValueError(f"{mark!r} must hold a control string and no backslash")
            end = pair[1]
            if any(end.startswith(end[i:]) for i in range(1, len(end))):
                raise ValueError(f"{end!r} can overlap itself")
        for c in self.control:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"control string {c!r}: two characters or more, no backslash")
            for d in self.control:  # an insertion into c must not be one into d as well
                if any(c[i:].startswith(d) or d.startswith(c[i:]) for i in range(1, len(c))):
                    raise ValueError(f"{c!r} and {d!r} can overlap")
        opens = [p[0] for p in (self.user, self.assistant, self.other)]
        if any(a != b and a.startswith(b) for a in opens for b in opens):
            raise ValueError("one opening mark begins another")

    def patterns(self):
        after = {}
        for c in self.control:
            after.setdefault(c[0], []).append(re.escape(c[1:]))
        rest = {k: "(?=" + "|".join(v) + ")" for k, v in after.items()}
        plain = re.compile("|".join(re.escape(k) + r"\\*" + v for k, v in rest.items()))
        marked = re.compile("|".join(re.escape(k) + r"\\+" + v for k, v in rest.items()))
        return (lambda s: plain.sub(lambda m: m[0] + "\\", s)), (lambda s: marked.sub(lambda m: m[0][:-1], s))

    def write(self, turns, escape):
        """(formatted text, [(start, end)] of the assistant texts in it)."""
        out, spans, at = [], [], 0
        for role, text in turns:
            a, b = self.user if role == "user" else self.assistant if role == "assistant" else self.other
            head = a if role in ("user", "assistant") else f"{a}{quote(role, safe='')}\n"
            body = escape(text)
            if role == "assistant":
                spans.append((at + len(head), at + len(head) + len(body)))
            out.append(f"{head}{body}{b}")
            at += len(out[-1])
        return "".join(out), spans

    def read(self, s: str, unescape):
        turns, at = [], 0
        while at < len(s):
            role, (a, b) = next((r, p) for r, p in (("user", self.user), ("assistant", self.assistant), (None, self.other)) if s.startswith(p[0], at))
            at += len(a)
            end = s.index(b, at)
            body = s[at:end]
            if role is None:
                name, _, body = body.partition("\n")
                role = unquote(name)
            turns.append((role, unescape(body)))
            at = end + len(b)
        return turns


def _per_row(df: DataFrame, inputs: list[str], added: T.StructType, fn):
    """Adds the fields of ``added``: ``fn`` maps a row of ``inputs`` to them; output batches hold few rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*df.schema.fields, *added.fields])
    arrow, kept = to_arrow_schema(schema), df.columns

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(a, _ROWS)
                rows = [fn(*r) for r in zip(*(batch.column(c).to_pylist() for c in inputs))]
                new = [pa.array([r[k] for r in rows], arrow.field(f.name).type) for k, f in enumerate(added.fields)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).cast(arrow.field(c).type) for c in kept), *new], schema=arrow)

    return df.mapInArrow(run, schema)


def format_turns(df: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``formatted`` and ``loss`` (code point spans) to a table with ``turns``."""
    _free(df, "formatted", "loss")
    added = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("loss", SPANS)])

    def one(turns):
        if turns is None:
            return None, None
        escape, _ = template.patterns()
        text, spans = template.write([(t["role"] or "", t["text"] or "") for t in turns], escape)
        return text, [{"start": a, "end": b} for a, b in spans]

    return _per_row(df, ["turns"], added, one)


def read_back(df: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``read_turns`` and ``loss_text`` (unescaped text under the mask), from ``formatted`` and ``loss`` alone."""
    _free(df, "read_turns", "loss_text")
    added = T.StructType([T.StructField("read_turns", TURNS), T.StructField("loss_text", T.StringType())])

    def one(text, loss):
        if text is None:
            return None, None
        _, unescape = template.patterns()
        turns = [{"role": r, "text": t} for r, t in template.read(text, unescape)]
        return turns, "".join(unescape(text[s["start"]:s["end"]]) for s in loss)

    return _per_row(df, ["formatted", "loss"], added, one)


def format_records(records: DataFrame, record: str = "record", layouts=LAYOUTS, template: Template = Template()) -> DataFrame:
    """JSON records of any known layout as training texts with a loss mask."""
    return format_turns(canonical_turns(records, record, layouts), template)

"""Secrets in whole texts, found by what they are assigned to (operator 12).

Plain patterns find the well-known shapes. The method adds what they can't see: it parses assignments as they stand in source code and in
configuration files into names and values. A value is a literal (quoted, or bare as in `key: value`), the name of something assigned elsewhere,
or a chain of both. Literals are carried along names: in `x = "..."; connect(password=x)` the literal of x is a password's. A literal's score is
the sensitivity of the most telling name that it reaches times its own strength, which is what its characters could hide.

The parser works outwards from operators (`=`, `:`, `:=`, `=>`), so prose, which has few, costs little more than a search for them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import text_chunks

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds in the order of their rows.
KINDS = ("assign", "access", "hex", "literal")


@dataclass(frozen=True)
class SecretRules:
    """What names tell. A name's words are weighed one by one and in pairs; a last word of `about` means that the value only tells of a secret."""

    least: float = 0.4
    min_length: int = 6
    enough_bits: float = 28.0
    words: dict[str, float] = field(default_factory=lambda: {
        "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 1.0, "pass": 0.8, "pw": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
        "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "jwt": 0.8, "signature": 0.5, "hmac": 0.6, "salt": 0.5, "pin": 0.4, "seed": 0.4, "dsn": 0.5, "mnemonic": 0.6,
    })
    pairs: dict[tuple[str, str], float] = field(default_factory=lambda: {
        ("api", "key"): 1.0, ("access", "key"): 0.9, ("private", "key"): 0.9, ("secret", "key"): 1.0, ("signing", "key"): 0.9, ("encryption", "key"): 0.9, ("session", "key"): 0.8, ("account", "key"): 0.8,
        ("shared", "key"): 0.8, ("master", "key"): 0.8, ("auth", "key"): 0.9, ("connection", "string"): 0.6,
    })
    about: frozenset[str] = frozenset("name names id ids url uri path file field type types length size count prompt hint label policy expiry ttl limit regex pattern header env var variable endpoint enabled required message error title description help placeholder column table prefix suffix format algorithm version".split())
    about_factor: float = 0.2


#: Values that stand in for a secret.
STAND_IN = re.compile(r"""change_?-?me|example|placeholder|your[_-]?|x{4,}|\*{3,}|^<.*>$|\$\{[\w.:-]+\}|^\$\(.*\)$|\{\{.*\}\}|^%\w+%$|^\$\w+$|redacted|^(?:none|null|nil|true|false|undefined|string|str|todo|tbd|test|dummy|empty|required|optional)$|^(.)\1*$""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
OPERATOR = re.compile(r"=>|:=|(?<![=!<>:])=(?![=~>])|(?<!:):(?![:=/])")
#: The name left of an operator, read backwards from it: plain or dotted, quoted, in brackets, a flag. Before `=` a type may stand between.
NAME = r"""(?:\]?\x20*(["'`])(?P<quoted>[^"'`\n]{1,80})\1|(?P<plain>[\w$]+(?:(?:\.|>-|-)[\w$]+)*))"""
TYPE = r"(?:[\w.\[\]<>*?]{1,40}(?:\x20?[|]\x20?[\w.\[\]<>*?]{1,40}){0,3}\x20*:(?!:)\x20*)?"
NAMED, TYPED = (re.compile(rf"[\x20\t]*{before}{NAME}", re.ASCII) for before in ("", TYPE))
STRING = re.compile(r"""(?:[rbufRBUF]{0,2}|@|L)?(?:"(?P<d>(?:[^"\\\n]|\\.)*)"|'(?P<s>(?:[^'\\\n]|\\.)*)'|`(?P<b>[^`\\]*)`)""", re.ASCII)
REFERENCE = re.compile(r"(?:this\.|self\.|\$\{?|@)?(?P<name>[A-Za-z_][\w]*(?:(?:\.|->)[A-Za-z_]\w*)*)\}?(?P<open>\x20*[(\[])?", re.ASCII)
SCHEME = re.compile(r"(?:Bearer|Basic|Token|Digest)\x20+(?=[^\s\"'])", re.IGNORECASE)
#: A bare value ends within 2,000 characters, or it is none; a quoted one with its line.
BARE = re.compile(r"""(?P<bare>[^\s"'`,;(){}\[\]<>]{1,2000}+)(?![^\s"'`,;(){}\[\]<>])""")
#: What joins two pieces of a value: an operator, which may stand at either end of a line, or a line that is carried on.
JOIN = re.compile(r"[\x20\t]*(?:(?:\+|\.\.|&|\.(?=[\x20\t]*[\"']))[\x20\t]*(?:\n[\x20\t]*)?|\\\n[\x20\t]*|\n[\x20\t]*(?:\+|\.\.)[\x20\t]*)?")
GAP = re.compile(r"[\x20\t(\[{]*")
FLAG = re.compile(r"""(?<!\S)--(?P<name>[A-Za-z][\w-]*)\x20+(?![-\x20])""", re.ASCII)
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*)>\s*(?P<value>[^<>\s]{1,400})\s*</(?P=name)>", re.ASCII)
#: Characters before an operator in which its name is looked for; pieces that a chain of values has at most.
NAME_REACH, PIECES = 200, 64


@dataclass
class Binding:
    name: str
    literals: list[tuple[int, int, bool]]
    references: list[str]


def plain_name(name: str) -> str:
    """A name as it is referred to: without self., this. or sigils."""
    return re.sub(r"^(?:self|this)\.|^[$@-]+", "", name)


def value_at(text: str, at: int) -> tuple[list[tuple[int, int, bool]], list[str]]:
    """Literals (start, end, quoted) and names of the value that begins at `at`."""
    literals, names = [], []
    at = GAP.match(text, at).end()
    if scheme := SCHEME.match(text, at):
        bare = BARE.match(text, scheme.end())
        return [(*bare.span("bare"), False)] if bare else [], names
    for piece in range(PIECES):
        if found := STRING.match(text, at):
            kind = next(k for k in "dsb" if found[k] is not None)
            literals.append((*found.span(kind), True))
        elif (found := REFERENCE.match(text, at)) and (piece or found["open"] or not _bare_word(text, found.end())):
            if found["open"]:  # a call or an index: what it gives isn't known
                break
            names.append(found["name"])
        elif not piece and (found := BARE.match(text, at)):
            literals.append((*found.span("bare"), False))
            bare = found["bare"]
            if re.fullmatch(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*", bare, re.ASCII):
                names.append(bare)
            break
        else:
            break
        joint = JOIN.match(text, found.end())
        if not text[found.end() : joint.end()].strip(" \t") and not STRING.match(text, joint.end()):
            break
        at = joint.end()
    return literals, names


def _bare_word(text: str, end: int) -> bool:
    """Whether a word goes on in a way no name does, or ends its line: then it can be a bare value."""
    return end >= len(text) or text[end] not in " \t+,;)]}.([&"


def bindings(text: str) -> list[Binding]:
    found = []
    for op in OPERATOR.finditer(text):
        before = text[max(0, op.start() - NAME_REACH) : op.start()][::-1].partition("\n")[0]
        if not (named := (TYPED if op[0] == "=" else NAMED).match(before)):
            continue
        name = plain_name((named["quoted"] or named["plain"])[::-1])
        literals, names = value_at(text, op.end())
        if literals or names:
            found.append(Binding(name, literals, [plain_name(n) for n in names]))
    for flag in FLAG.finditer(text):
        if value := STRING.match(text, flag.end()) or BARE.match(text, flag.end()):
            group = next(k for k, v in value.groupdict().items() if v is not None)
            found.append(Binding(flag["name"], [(*value.span(group), group != "bare")], []))
    found += [Binding(e["name"], [(*e.span("value"), False)], []) for e in ELEMENT.finditer(text)]
    return found


def sensitivity(name: str, rules: SecretRules) -> float:
    """From 0 to 1: how much a name says that its value is secret."""
    words = [w.lower() for w in WORD.findall(name)]
    if not words:
        return 0.0
    best = max([rules.words.get(w, 0.0) for w in words] + [rules.pairs.get(p, 0.0) for p in zip(words, words[1:])])
    return best * (rules.about_factor if words[-1] in rules.about else 1.0)


def strength(value: str, quoted: bool, rules: SecretRules) -> float:
    """From 0 to 1: the bits that the characters of value could hide, against enough_bits; stand-ins and prose have none."""
    n = len(value)
    if n < rules.min_length or STAND_IN.search(value):
        return 0.0
    bits = -sum(c * math.log2(c / n) for c in Counter(value).values())
    score = min(1.0, bits / rules.enough_bits)
    kinds = sum(bool(re.search(k, value)) for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    if re.search(r"\s", value) or re.match(r"[a-z]+://[^@]*$|[./~]", value):
        score *= 0.3
    if kinds == 1 and not value.isdigit() or not quoted and kinds < 3 and not re.search("[0-9]", value):
        score *= 0.4  # a word
    return score


def telling_names(found: list[Binding], rules: SecretRules) -> list[float]:
    """For each binding the sensitivity of the most telling name that its value reaches, through any number of others."""
    reach: dict[str, float] = {}
    feeds: dict[str, set[str]] = {}  # name -> names that are made from it
    for b in found:
        reach[b.name] = max(reach.get(b.name, 0.0), sensitivity(b.name, rules))
        for r in b.references:
            feeds.setdefault(b.name, set()).add(r)
    # from the most telling name back to what feeds it: each name is settled once, by the best that it reaches
    waiting = sorted(reach, key=reach.get)
    settled: set[str] = set()
    for start in reversed(waiting):
        stack = [start]
        while stack:
            name = stack.pop()
            if name in settled:
                continue
            settled.add(name)
            reach[name] = max(reach.get(name, 0.0), reach[start])
            stack += feeds.get(name, ())
    return [reach[b.name] for b in found]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def lexed_spans(text: str, base: list[tuple[str, int, int]], rules: SecretRules) -> list[tuple[str, int, int]]:
    """Literals that score `least` or more and don't lie in a span that is known, widest first."""
    found = bindings(text)
    spans = set()
    for b, telling in zip(found, telling_names(found, rules)):
        if telling >= rules.least and b.literals:
            value = "".join(text[start:end] for start, end, _ in b.literals)  # pieces of a chain are one value
            if telling * strength(value, b.literals[0][2], rules) >= rules.least:
                spans |= {(start, end) for start, end, _ in b.literals if end > start}
    kept, known = [], sorted((s, e) for _, s, e in base)
    for start, end in sorted(spans, key=lambda x: (x[0], -x[1])):
        if not (kept and end <= kept[-1][2]) and not _inside(known, start, end):
            kept.append(("literal", start, end))
    return kept


def _inside(known: list[tuple[int, int]], start: int, end: int) -> bool:
    from bisect import bisect_right

    # spans of one kind don't overlap, so only the last few that begin before can hold it
    at = bisect_right(known, (start, math.inf))
    return any(e >= end for _, e in known[max(0, at - 3) : at])


def named(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def scan(text: str, rules: SecretRules) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    count = Counter(k for k, _, _ in base)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(named(base).encode()).hexdigest(), named(base + lexed_spans(text, base, rules))


COLUMNS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def secret_spans(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans, one row for each row of docs(doc_id long, text string).

    A span is kind:start:end in code points, end exclusive: assign, access and hex by their patterns, literal by what a value is assigned to.
    A null or empty text has none. Whole texts are read; repeated rows each give a row, null doc_ids stay null, other columns are not read, an
    empty table gives an empty one. Bytes that aren't UTF-8 count as U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            found = list(zip(*(scan(t.decode("utf-8", "replace"), rules) for t in texts)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in found[:3]), *(pa.array(c, pa.string()) for c in found[3:])], ["doc_id", *COLUMNS])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(docs: DataFrame, mark: str = "[secret]", rules: SecretRules = SecretRules()) -> DataFrame:
    """docs with every span of its texts replaced by mark; overlapping spans by one. All columns stay, a null text stays null."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            out = []
            for known, raw in zip(part.column(at).is_valid().to_pylist(), texts):
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                pieces, end = [], 0
                for start, stop in sorted((s, e) for _, s, e in base + lexed_spans(text, base, rules)):
                    if start >= end:
                        pieces += [text[end:start], mark]
                    end = max(end, stop)
                out.append("".join([*pieces, text[end:]]) if known else None)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(part.columns)], part.schema.names)

    return docs.mapInArrow(run, docs.schema)

"""Secret scanning with a trigram inverted index.

A rule is a regular expression with a Boolean trigram query derived from its
parse tree: a text can only match if, for one of the alternatives, it holds
every trigram of it (letters folded to lower case).  Texts are indexed in
shards, one a batch: postings from each needed trigram to the rows that hold
it.  Postings are intersected, joined over the alternatives, and only the
candidates are verified with the regular expression, over the whole text.
Rules that force no trigram scan every text.

The index of a shard lies beside its texts, so nothing is shuffled and a lost
executor costs the batches it held.

Defined results: null text is empty and has no spans; a null or repeated
doc_id is a row like any other; an empty table gives no rows; other columns
are kept by `redact` and not read by `scan`.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices_by_bytes

#: Alternatives of a trigram query beyond which a part is taken as "anything".
MOST = 64


@dataclass(frozen=True)
class Rule:
    """``group``/``least``: a match counts if that group has as many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False
    compiled: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", re.compile(self.pattern))


#: The base kinds, in their listed order, then common public token formats.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                   r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    # a maximal run of 16 or more is the same as a maximal run, kept if 16 or longer
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    # from the start of a run only, and each run is read once: linear on any text
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)


def _strings(tree) -> list[list[str | None]]:
    """Ways through a parsed pattern; each is a list of exact texts and gaps (None)."""
    ways: list[list[str | None]] = [[]]

    def add(options: list[list[str | None]]) -> None:
        nonlocal ways
        if len(ways) * len(options) > MOST:
            options = [[None]]
        out = []
        for a, b in product(ways, options):
            if a and b and a[-1] is not None and b[0] is not None:
                out.append([*a[:-1], a[-1] + b[0], *b[1:]])
            else:
                out.append([*a, *b])
        seen = dict.fromkeys(tuple(x) for x in out)
        ways = [list(x) for x in seen]

    for op, arg in tree:
        if op is sre.LITERAL:
            add([[chr(arg).lower()]])
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            add([[c] for c in dict.fromkeys(chr(v).lower() for _, v in arg)])
        elif op is sre.SUBPATTERN:
            add(_strings(arg[-1]))
        elif op is sre.BRANCH:
            add([w for branch in arg[1] for w in _strings(branch)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1:
            add([[""], *_strings(arg[2])])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            for _ in range(min(arg[0], 3)):
                add(_strings(arg[2]))
            if arg[1] != arg[0] or arg[0] > 3:
                add([[None]])
        else:
            add([[None]])
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives (or) of trigram sets (and) that every match must hold; None: scan fully."""
    query = set()
    for way in _strings(sre_parse.parse(pattern)):
        grams = frozenset(s[i:i + 3] for s in way if s for i in range(len(s) - 2))
        if not grams:
            return None
        query.add(grams)
    smallest = [q for q in query if not any(o < q for o in query)]
    return sorted(smallest, key=sorted)


class ShardIndex:
    """Postings of the needed trigrams over the texts of one shard.

    Lower-casing keeps ASCII trigrams in place; other letters that fold to
    ASCII can only add candidates.
    """

    def __init__(self, texts: list[str], grams: set[str]):
        self.all = range(len(texts))
        folded = [t.lower() for t in texts]
        self.postings = {g: [i for i, t in enumerate(folded) if g in t] for g in grams}

    def candidates(self, query: list[frozenset[str]] | None):
        if query is None:
            return self.all
        rows: set[int] = set()
        for grams in query:
            lists = sorted((self.postings[g] for g in grams), key=len)
            hits = set(lists[0])
            for other in lists[1:]:
                if not hits:
                    break
                hits.intersection_update(other)
            rows |= hits
        return sorted(rows)


def find_spans(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text its spans ``(start, rule number, end)`` in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = ShardIndex(texts, {g for q in queries if q for grams in q for g in grams})
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for n, (rule, query) in enumerate(zip(rules, queries)):
        for i in index.candidates(query):
            for m in rule.compiled.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[i].append((m.start(), n, m.end()))
    for spans in found:
        spans.sort()
    return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, spans, kinds, base_sha256, span_text`` of every row.

    ``spans`` is an array of ``struct<kind, start, end>`` in code points, end
    exclusive.  ``base_sha256`` digests the base kinds' spans and
    ``span_text`` lists all, as ``kind:start:end`` joined by commas.
    """
    schema = ("doc_id long, spans array<struct<kind:string,start:long,end:long>>, base_sha256 string, "
              "span_text string")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                spans, digests, lines = [], [], []
                for own in find_spans(texts, rules):
                    named = [f"{rules[n].kind}:{a}:{b}" for a, n, b in own]
                    base = ",".join(x for x, (_, n, _) in zip(named, own) if rules[n].base)
                    spans.append([{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in own])
                    digests.append(hashlib.sha256(base.encode()).hexdigest())
                    lines.append(",".join(named))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(spans, pa.list_(span)),
                     pa.array(digests, pa.string()), pa.array(lines, pa.string())],
                    ["doc_id", "spans", "base_sha256", "span_text"])

    return docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text").mapInArrow(run, schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
           mark: str = "[{}]") -> DataFrame:
    """All rows and columns; every secret in the text replaced by its kind in brackets."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, text_col):
                texts = part.column(at).to_pylist()
                out = []
                for text, spans in zip(texts, find_spans([t or "" for t in texts], rules)):
                    last, pieces = 0, []
                    for a, n, b in spans:
                        if a >= last:
                            pieces += [text[last:a], mark.format(rules[n].kind)]
                        last = max(last, b)
                    out.append(text if not spans else "".join([*pieces, text[last:]]))
                yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    return docs.mapInArrow(run, schema)

"""Secret scan with one combined deterministic automaton.

The rules' regexes are compiled, reversed, into one automaton: union, subset construction,
minimisation, transition arrays. One pass over a text's bytes, from its end, reports every
position where a match of some rule begins. From the leftmost such position the rule's own
automata give the longest match; the search goes on after it, so matches of a kind never overlap.

A rule is a head followed by a body; a match counts if the body is at least ``min_body`` long,
otherwise it is dropped (and still consumes its characters). No head may end in a way that the
body could begin, so the longest head is the right one. A rule's ``rest`` carries a counted match
on: a private key runs through its END line, or, without one, to the last line that looks like key.

Defined results: a null or empty text has no spans; offsets are code points, end exclusive;
repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    body: str
    min_body: int = 1
    rest: str = ""  # carries a counted match on as far as it goes; white space at its end stays out


BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
         r"[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 12),
    Rule("hex", r"", r"[0-9a-f]{32,}", 32),
)
# A private key after its BEGIN line: header lines, long key runs and lines of key characters only (line
# ends may be escaped), then the END line if it follows. Prose is no key line, so a heading that a text
# merely quotes ends at the first line of words, whatever END line comes later.
_EOL = r"""[\x20\t"',]*(\r|\n|\\r|\\n)"""
_GAP = r"""([\x20\t\r\n"'>|*#,]|\\r|\\n)*"""
KEY_BLOCK = ("(" + _GAP + r"([A-Za-z0-9+/=]{16,}|[A-Za-z0-9+/=]+" + _EOL +
             r"|(Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*" + _EOL + "))*"
             "(" + _GAP + "[A-Za-z0-9+/=]*" + _GAP + r"-----END [ A-Z0-9]*PRIVATE KEY[ A-Z]*-----|)")
# Public token formats beyond the base kinds.
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH |PGP |ENCRYPTED )?PRIVATE KEY", r"[ A-Z]*-----", 5, KEY_BLOCK),
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", 35),
)
RULES = BASE_RULES + EXTRA_RULES


class _Nfa:
    """Thompson automaton over byte sets, from the parsed form of a regex."""

    def __init__(self):
        self.eps: list[list[int]] = []
        self.edges: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.eps.append([])
        self.edges.append([])
        return len(self.eps) - 1

    def seq(self, items, start: int, back: bool, fold: bool) -> int:
        for op, arg in reversed(list(items)) if back else items:
            start = self.piece(op, arg, start, back, fold)
        return start

    def piece(self, op, arg, start: int, back: bool, fold: bool) -> int:
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY):
            end = self.state()
            self.edges[start].append((byte_set(op, arg, fold), end))
            return end
        if op is sre.SUBPATTERN:
            _, on, _, items = arg
            return self.seq(items, start, back, fold or bool(on & re.I))
        if op is sre.BRANCH:
            end = self.state()
            for items in arg[1]:
                s = self.state()
                self.eps[start].append(s)
                self.eps[self.seq(items, s, back, fold)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            low, high, items = arg
            for _ in range(low):
                start = self.seq(items, start, back, fold)
            if high is sre.MAXREPEAT:
                loop = self.state()
                self.eps[start].append(loop)
                self.eps[self.seq(items, loop, back, fold)].append(loop)
                end = self.state()
                self.eps[loop].append(end)
                return end
            end = self.state()
            for _ in range(high - low):
                self.eps[start].append(end)
                start = self.seq(items, start, back, fold)
            self.eps[start].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")


def byte_set(op, arg, fold: bool) -> frozenset:
    if op is sre.ANY:
        return frozenset(range(256)) - {10}
    if op is sre.LITERAL:
        got = {arg}
    elif op is sre.NOT_LITERAL:
        got = set(range(256)) - {arg}
    else:
        got, negate = set(), False
        for o, a in arg:
            if o is sre.NEGATE:
                negate = True
            elif o is sre.LITERAL:
                got.add(a)
            elif o is sre.RANGE:
                got.update(range(a[0], a[1] + 1))
            else:
                raise ValueError(f"not supported in a class: {o}")
        if negate:
            got = set(range(256)) - got
    if fold:
        got |= {b ^ 32 for b in got if 65 <= b <= 90 or 97 <= b <= 122}
    if got and max(got) > 255:
        raise ValueError("rules are matched on bytes")
    return frozenset(got)


@dataclass(frozen=True)
class Dfa:
    table: list  # state -> tuple of 256 next states
    accepts: list  # state -> bit set of accepted rules
    start: int
    dead: frozenset  # states that are never left


def compile_rules(patterns, back: bool, anywhere: bool) -> Dfa:
    """Union of ``patterns`` as a minimal automaton; ``anywhere``: a match may begin at every byte."""
    nfa = _Nfa()
    root, finals = nfa.state(), {}
    for k, p in enumerate(patterns):
        s = nfa.state()
        nfa.eps[root].append(s)
        finals[nfa.seq(sre_parser.parse(p), s, back, False)] = 1 << k
    sets = {bs for e in nfa.edges for bs, _ in e}
    letter: dict[tuple, int] = {}
    of_byte = [letter.setdefault(tuple(b in bs for bs in sets), len(letter)) for b in range(256)]
    sample = [of_byte.index(c) for c in range(len(letter))]

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    base = closure([root])
    index, todo, moves = {base: 0}, [base], []
    while todo:  # subset construction over byte classes
        now = todo.pop(0)
        row = []
        for b in sample:
            to = closure([t for s in now for bs, t in nfa.edges[s] if b in bs])
            if anywhere:
                to |= base
            if to not in index:
                index[to] = len(index)
                todo.append(to)
            row.append(index[to])
        moves.append(row)
    accepts = [0] * len(index)
    for states, i in index.items():
        for s in states:
            accepts[i] |= finals.get(s, 0)
    block = accepts[:]  # minimisation by refinement
    while True:
        ids: dict[tuple, int] = {}
        new = [ids.setdefault((block[i], *[block[t] for t in moves[i]]), len(ids)) for i in range(len(moves))]
        if len(ids) == len(set(block)):
            break
        block = new
    ids = {}
    new = [ids.setdefault(block[i], len(ids)) for i in range(len(moves))]
    first = [new.index(c) for c in range(len(ids))]
    small = [[new[t] for t in moves[i]] for i in first]
    dead = frozenset(i for i, r in enumerate(small) if set(r) == {i} and not accepts[first[i]])
    return Dfa([tuple(r[c] for c in of_byte) for r in small], [accepts[i] for i in first], new[0], dead)


class Scanner:
    """Transition arrays of a rule set and the scan of one text."""

    def __init__(self, rules=RULES):
        self.rules = rules
        both = compile_rules([r.head + r.body for r in rules], back=True, anywhere=True)
        # accepting states last, so that one comparison finds them
        order = sorted(range(len(both.table)), key=lambda s: both.accepts[s] != 0)
        at = {s: i for i, s in enumerate(order)}
        self.table = [tuple(at[t] for t in both.table[s]) for s in order]
        self.accepts = [both.accepts[s] for s in order]
        self.first_accept = next((i for i, a in enumerate(self.accepts) if a), len(order))
        self.start = at[both.start]
        self.heads = [compile_rules([r.head], False, False) for r in rules]
        self.bodies = [compile_rules([r.body], False, False) for r in rules]
        self.rests = [compile_rules([r.rest], False, False) if r.rest else None for r in rules]

    @staticmethod
    def longest(dfa: Dfa, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``, or -1."""
        s, end, table, accepts = dfa.start, at if dfa.accepts[dfa.start] else -1, dfa.table, dfa.accepts
        for i in range(at, len(data)):
            s = table[s][data[i]]
            if accepts[s]:
                end = i + 1
            elif s in dfa.dead:
                break
        return end

    def starts(self, data: bytes) -> list[tuple[int, int]]:
        """(position, rules) where matches begin, from the end of the text to its start."""
        s, table, first, out, n = self.start, self.table, self.first_accept, [], len(data) - 1
        for i, b in enumerate(reversed(data)):
            s = table[s][b]
            if s >= first:
                out.append((n - i, self.accepts[s]))
        return out

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """Spans (start, end, rule index) in code points, ordered by start, then rule."""
        if not text:
            return []
        data = text.encode("utf-8", "replace")
        found = self.starts(data)
        if not found:
            return []
        found.reverse()
        spans = []
        for k, rule in enumerate(self.rules):
            cursor = 0
            for at, mask in found:
                if at < cursor or not mask >> k & 1:
                    continue
                mid = self.longest(self.heads[k], data, at)
                end = self.longest(self.bodies[k], data, mid) if mid >= 0 else -1
                if end < 0:
                    continue
                if end - mid >= rule.min_body:
                    if rule.rest:  # the end of the text ends its last line
                        more = self.longest(self.rests[k], data + b"\n", end)
                        end += len(data[end:max(end, more)].rstrip())
                    spans.append((at, end, k))
                cursor = end
        if len(data) != len(text):  # byte offsets to code points
            points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            spans = [(int(points[a]) - 1, int(points[b - 1]), k) for a, b, k in spans]
        spans.sort(key=lambda x: (x[0], x[2]))
        return spans


@functools.lru_cache(maxsize=4)
def scanner(rules=RULES) -> Scanner:
    return Scanner(rules)


def redact(text: str | None, spans, mark: str = "[SECRET]") -> str | None:
    """The text with every maximal run of spanned characters replaced by ``mark``."""
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def scan(df: DataFrame, text: str = "text", out: str = "secrets", rules=RULES, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with a struct column ``out``: ``spans`` (array of start, end, kind) and ``redacted``
    (the text without the secrets; null where there are none)."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("kind", T.StringType())])
    field = T.StructField(out, T.StructType([T.StructField("spans", T.ArrayType(span)),
                                             T.StructField("redacted", T.StringType())]))
    at = df.columns.index(text)
    span_type = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def run(batches):
        sc = scanner(rules)
        for batch in batches:
            spans, clean = [], []
            for v in batch.column(at):
                t = v.as_py()
                got = sc.scan(t)
                spans.append([{"start": a, "end": b, "kind": rules[k].kind} for a, b, k in got])
                clean.append(redact(t, got, mark) if got else None)
            res = pa.StructArray.from_arrays([pa.array(spans, pa.list_(span_type)), pa.array(clean, pa.string())],
                                             names=["spans", "redacted"])
            yield pa.RecordBatch.from_arrays([*batch.columns, res], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, field]))

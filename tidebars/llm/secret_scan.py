"""Secret scans in DataFrame functions alone.

Base secrets are found by three patterns. Places come from cutting the text at the matches: a match starts after the lengths
of all gaps and matches before it. Other candidates are long runs of letters that secrets are made of; a window slides over
each, the counts of its letters and the sum of c * log2(c) over them change by one letter in and one letter out, and the
stretch from the first to the last window whose entropy reaches the class's bound is a secret, unless the candidate is on the
allow-list or the stretch touches a base secret.

A null text counts as empty; repeated rows are scanned each on its own. Places are code points, ends excluded.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.frames import beside, restore, with_results

#: The patterns of base secrets; what is shorter than the least length is dropped after matching.
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: As they are searched for. A run of letters is matched as a whole, so the least length can be part of two patterns.
BASE = (("assign", ASSIGN), ("access", r"AKIA[A-Z0-9]{12,}"), ("hex", r"[0-9a-f]{32,}"))

#: Candidates that are no secrets: ids of the usual form, checksums, words joined by signs, examples from manuals.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(sha1|sha256|sha384|sha512|md5)-",
    r"^[A-Za-z]++(?:[/_-]++[A-Za-z]*+[0-9]{0,4}+)*+$",
    r"EXAMPLE",
)


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of one kind: a pattern, what a candidate must also hold, its letters (alike ones in one place), the size of
    the window and the least entropy in bits."""

    kind: str
    pattern: str
    holds: tuple[str, ...]
    letters: tuple[str, ...]
    window: int
    bits: float

    @property
    def most(self) -> int:
        """The greatest sum of c * log2(c), in millionths, of a window that reaches the bound."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * 1_000_000)

    @property
    def steps(self) -> list[int]:
        """c * log2(c) in millionths, by c."""
        return [0] + [round(c * math.log2(c) * 1_000_000) for c in range(1, self.window + 1)]


CLASSES = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]{24,}", ("[0-9]", "[A-Fa-f]"), ("0123456789abcdef", "          ABCDEF"), 24, 2.9),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", ("[0-9]", "[A-Z]", "[a-z]"),
                 ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", " " * 62 + "-_"), 20, 3.7),
    EntropyClass("entropy_base36", r"[0-9a-z]{20,}", ("[0-9]", "[g-z]"), ("0123456789abcdefghijklmnopqrstuvwxyz", ""), 20, 3.6),
    EntropyClass("entropy_base32", r"[0-9A-Z]{20,}", ("[0-9]", "[G-Z]"), ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""), 20, 3.6),
)
KINDS = tuple(k for k, _ in BASE) + tuple(c.kind for c in CLASSES)
RESULTS = ["n_assign", "n_access", "n_hex", "spans"]

_SPAN = "struct<kind: string, start: int, end: int>"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _in_blocks(array: str, name: str, each: str, body: str) -> str:
    """SQL: ``body`` over ``blocks``, what ``each`` makes of the blocks ``name`` of an array that is not empty.

    An array that grows by one element at a time is copied each time. In blocks of about the root of its length, and then
    block by block, that costs the root of the length for each element and not the length.
    """
    cut = f"transform(sequence(0, cast((size(whole) - 1) div wide AS int)), b -> {_let('slice(whole, b * wide + 1, wide)', name, each)})"
    return _let(array, "whole", _let("cast(ceil(sqrt(size(whole))) AS int)", "wide", _let(cut, "blocks", body)))


_PLACES = "array<struct<start: int, end: int, value: string>>"


def _places(text: str, pattern: str) -> str:
    """SQL: the matches of a pattern as an array of (start, end, value)."""
    p = _text(pattern)
    local = f"""aggregate(own, named_struct('at', 0, 'out', cast(array() AS {_PLACES})),
        (a, x) -> named_struct('at', a.at + length(x['0']) + coalesce(length(x['1']), 0), 'out', if(x['1'] IS NULL, a.out, concat(a.out,
            array(named_struct('start', a.at + length(x['0']), 'end', a.at + length(x['0']) + length(x['1']), 'value', x['1']))))))"""
    starts = "aggregate(blocks, array(0), (s, l) -> concat(s, array(element_at(s, -1) + l.at)))"
    shifted = """flatten(transform(blocks, (l, i) -> transform(l.out,
        m -> named_struct('start', m.start + starts[i], 'end', m.end + starts[i], 'value', m.value))))"""
    found = _in_blocks(f"arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0))", "own", local, _let(starts, "starts", shifted))
    return f"CASE WHEN {text} RLIKE {p} THEN {found} ELSE cast(array() AS {_PLACES}) END"


def _codes(value: str, c: EntropyClass) -> str:
    """SQL: the place of each letter of a candidate among the letters of its class."""
    first, second = (_text(x) for x in c.letters)
    return f"transform(filter(split({value}, ''), z -> z <> ''), z -> if(instr({first}, z) > 0, instr({first}, z), instr({second}, z)) - 1)"


def _stretch(codes: str, c: EntropyClass) -> str:
    """SQL: (first, last): the stretch of windows that reach the bound, ends excluded; last is 0 if none does."""
    n, w, steps = len(c.letters[0]), c.window, f"array({', '.join(map(str, c.steps))})"
    # sum: over the letters of the window; one letter comes in, and from the w-th step on one goes out
    return f"""aggregate(sequence(0, size({codes}) - 1),
        named_struct('counts', array_repeat(0, {n}), 'sum', 0, 'first', 0, 'last', 0),
        (s, i) -> transform(array(named_struct('come', element_at({codes}, i + 1), 'gone', if(i < {w}, -1, element_at({codes}, i - {w} + 1)))),
            e -> transform(array(named_struct(
                'counts', transform(s.counts, (v, j) -> v + if(j = e.come, 1, 0) - if(j = e.gone, 1, 0)),
                'sum', s.sum + if(e.come = e.gone, 0,
                    {steps}[s.counts[e.come] + 1] - {steps}[s.counts[e.come]]
                    + if(e.gone < 0, 0, {steps}[s.counts[greatest(e.gone, 0)] - 1] - {steps}[s.counts[greatest(e.gone, 0)]])))),
                t -> named_struct('counts', t.counts, 'sum', t.sum,
                    'first', if(s.last = 0 AND i >= {w - 1} AND t.sum <= {c.most}, i - {w - 1}, s.first),
                    'last', if(i >= {w - 1} AND t.sum <= {c.most}, i + 1, s.last)))[0])[0],
        s -> named_struct('first', s.first, 'last', s.last))"""


def _base(text: str, kind: str, pattern: str) -> str:
    """SQL: the places of a base kind, which do not overlap."""
    keep = f"length(regexp_extract(m.value, {_text(pattern)}, 2)) >= {LEAST[kind]}" if kind == "assign" else "true"
    return f"transform(filter({_places(text, pattern)}, m -> {keep}), m -> named_struct('kind', '{kind}', 'start', m.start, 'end', m.end))"


def _mask(places: str) -> str:
    """SQL: a byte for each character up to the last place, x inside places."""
    return f"""cast(array_join(transform({places}, (m, i) -> concat(
        repeat('.', m.start - if(i = 0, 0, {places}[greatest(i, 1) - 1].end)), repeat('x', m.end - m.start))), '') AS binary)"""


def _entropy(text: str, allowed: tuple[str, ...]) -> str:
    found = []
    for c in CLASSES:
        keep = [f"m.value RLIKE {_text(p)}" for p in c.holds] + [f"NOT m.value RLIKE {_text(p)}" for p in allowed]
        own = f"transform(filter({_places(text, c.pattern)}, m -> {' AND '.join(keep)}), m -> named_struct('start', m.start, 'codes', {_codes('m.value', c)}))"
        stretches = f"transform({own}, m -> named_struct('start', m.start, 'own', {_stretch('m.codes', c)}))"
        found.append(f"transform(filter({stretches}, m -> m.own.last > 0), m -> named_struct('kind', '{c.kind}',"
                     f" 'start', m.start + m.own.first, 'end', m.start + m.own.last))")
    return f"concat({', '.join(found)})"


def _spans(flat: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """``flat`` with ``spans`` in place of the text in ``made``: by start, then kind as in ``KINDS``."""
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    base = [f"base_{k}" for k, _ in BASE]
    free = " AND ".join(f"instr(cast(substring(masks.{k}, x.start + 1, x.end - x.start) AS string), 'x') = 0" for k, _ in BASE)
    # bound once outside the filter: a column used once is put in its place, and would be made again for each element
    masks = "named_struct(" + ", ".join(f"'{k}', {_mask(f'base_{k}')}" for k, _ in BASE) + ")"
    return (
        flat.withColumn("made", F.coalesce("made", F.lit("")))
        .withColumns({f"base_{k}": F.expr(_base("made", k, p)) for k, p in BASE} | {"more": F.expr(_entropy("made", allowed))})
        .withColumn("more", F.expr(_let(masks, "masks", f"filter(more, x -> {free})")))
        .withColumn("made", F.expr(
            f"transform(array_sort(transform(concat({', '.join(base)}, more), x -> named_struct('start', x.start, 'rank', {order}, 'kind', x.kind, 'end', x.end))),"
            " x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end))"))
        .drop("more", *base)
    )


def find_secrets(docs: DataFrame, text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``secrets``, an array of (kind, start, end) by start, then kind as in ``KINDS``.

    ``allowed``: patterns; entropy candidates that match one are no secrets.
    """
    found = _spans(beside(docs, [text], lambda t: t), allowed)
    names = [*(n for n in docs.columns if n.lower() != "secrets"), "secrets"]
    places = [f"c{i}" for i, n in enumerate(docs.columns) if n.lower() != "secrets"]
    return found.select(*places, "made").toDF(*names)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with each secret in the texts replaced by ``mark``; secrets that overlap are replaced as one."""
    own = f"c{docs.columns.index(text)}"
    found = _spans(beside(docs, [text], lambda t: t), allowed)
    some = "cast(array() AS array<struct<start: int, end: int>>)"
    joined = f"""aggregate(own, {some}, (a, x) -> if(size(a) > 0 AND x.start < element_at(a, -1).end,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(x.end, element_at(a, -1).end)))),
        concat(a, array(named_struct('start', x.start, 'end', x.end)))))"""
    # the spans of a block that begin before the last one so far ends are part of it
    further = _let("element_at(a, -1)", "e", """concat(slice(a, 1, size(a) - 1),
        array(named_struct('start', e.start, 'end', greatest(e.end, coalesce(array_max(transform(filter(l, y -> y.start < e.end), y -> y.end)), 0)))),
        filter(l, y -> y.start >= e.end))""")
    merged = f"""CASE WHEN size(made) = 0 THEN {some} ELSE {_in_blocks("made", "own", joined,
        f"aggregate(blocks, {some}, (a, l) -> if(size(a) = 0, l, {further}))")} END"""
    # a block's part of the text is cut out first, so that a cut in it does not look through the whole text
    cut = f"""array_join(transform(own, (x, i) -> concat(substring(part, if(i = 0, 0, own[greatest(i, 1) - 1].end - begin) + 1,
        x.start - if(i = 0, begin, own[greatest(i, 1) - 1].end)), {_text(mark)})), '')"""
    part = _let("if(b = 0, 0, whole[greatest(b * wide, 1) - 1].end)", "begin",
                _let(f"substring({own}, begin + 1, element_at(own, -1).end - begin)", "part", cut))
    clean = f"""CASE WHEN size(made) = 0 THEN {own} ELSE concat({_in_blocks("made", "own", part, "array_join(blocks, '')")},
        substring({own}, element_at(made, -1).end + 1)) END"""
    return restore(found.withColumn("made", F.expr(merged)).withColumn(own, F.expr(clean)), docs.columns)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

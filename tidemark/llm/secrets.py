"""Secret scans: fixed formats, and values in a credential's context judged by what guessing them would cost.

Base kinds (leftmost, not overlapping within a kind): `assign` (key, sign, value of six or more), `access` (AKIA keys of
20 or more), `hex` (24 or more). The method adds kind `guess`: a value that follows a credential word and a sign, and
whose guess cost is at least MIN_LOG10 decimal digits. The cost is the cheapest segmentation of the value into common
words, dates, repeats, keyboard walks and brute-force spans, found by dynamic programming: each segment costs the
logarithm of the guesses that enumerate it, and each further segment a little for the order of segments. So `changeme`,
`2024-01-01` or `xxxxxxxx` in such a place are cheap and no secret; a random value is dear. Spans inside a base span add
nothing and are left out.

The programme takes time in proportion to the value: a repeat or a walk starts among the first HEAD characters of its
maximal run, long repeats are cut to a few times before and counted whole, and costs are told apart up to CEILING digits,
where the programme stops.

Defined results: a null text counts as empty and has no spans. Texts are scanned whole, whatever their length. Each row
gives one result row, repeated ones too; an empty table gives an empty result; other columns are ignored. Spans are in
code points, the end exclusive, sorted by start, then kind as listed.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
#: A value counts as a secret from so many decimal digits of guesses.
MIN_LOG10 = 10.0
MIN_VALUE = 8
#: Costs of so many digits and more are given as this.
CEILING = 60.0
#: A repeat or walk that begins later within a run of its kind is no segment of its own.
HEAD = 16
MASK = "[secret]"

# The formats that scans are asked for.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Words that announce a credential, then a sign, then the value.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth(?:orization|[_-]?key)?|private[_-]?key|access[_-]?key|client[_-]?secret|bearer)["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:bearer\x20+|basic\x20+)?["'`]?([^\s"'`,;<>(){}\[\]]+)""",
    re.IGNORECASE | re.ASCII,
)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
# Common words in passwords, the commonest first.
_WORDS = (
    "password pass admin login welcome secret letmein changeme default root user test guest example sample master "
    "dragon monkey shadow sunshine princess football baseball soccer hockey iloveyou love hello summer winter spring "
    "autumn monday friday january october company server database backup system service access token key api auth "
    "value string none null true false todo here your my the this that placeholder dummy foo bar demo temp new old "
    "super star power magic secure private public internal live dev prod stage main"
).split()
_RANK = {w: k + 1 for k, w in enumerate(_WORDS)}
_LONGEST = max(map(len, _WORDS))
_LEET = str.maketrans("@4310$57!", "aaeiossti")
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATES = (
    (re.compile(r"(?:19|20)\d\d"), 130),
    (re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"), 130 * 366 * 4),
    (re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"), 130 * 366 * 4),
)


def _near() -> dict[tuple[str, str], tuple[int, int]]:
    """Ordered pairs of keys that touch, and the way from one to the other: along a row, or to the next row in the same
    or the neighbouring column."""
    out = {}
    for r, row in enumerate(_ROWS):
        for c, key in enumerate(row):
            for down, right in ((0, 1), (1, 0), (1, -1)):
                if r + down < len(_ROWS) and 0 <= c + right < len(_ROWS[r + down]):
                    other = _ROWS[r + down][c + right]
                    out[key, other], out[other, key] = (down, right), (-down, -right)
    return out


_TOUCH = _near()


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100


def _spread(value: str) -> int:
    """Guesses for a character that the rest of the value tells about: letters that read like a word, or hex digits."""
    if value.isalpha():
        vowels = sum(c in "aeiouy" for c in value.lower()) / len(value)
        # a word of some language is far from random
        return 5 if (value.islower() or value.isupper() or value.istitle()) and (0.2 <= vowels <= 0.65 or not value.isascii()) else 0
    return 16 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) and not value.isdigit() else 0


_LONG_REPEAT = re.compile(r"(.{1,4}?)\1{%d,}" % (2 * HEAD), re.DOTALL)


def _shortened(value: str) -> tuple[str, dict[int, int]]:
    """The value without the middle of long repeats, and how many characters are left out before which place."""
    out, cuts, at, size = [], {}, 0, 0
    for m in _LONG_REPEAT.finditer(value):
        block = m.end(1) - m.start(1)
        head, tail = m.start() + HEAD * block, m.end() - HEAD * block
        out += [value[at:head]]
        size += head - at
        cuts[size] = tail - head
        at = tail
    return ("".join([*out, value[at:]]), cuts) if cuts else (value, cuts)


@lru_cache(maxsize=20_000)
def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation needs, CEILING at most; 0 for an empty value."""
    spread = _spread(value) if value else 0
    value, cuts = _shortened(value)
    n = len(value)
    low, plain = value.lower(), value.lower().translate(_LEET)
    if len(low) != n:  # a letter whose lower case is longer
        low = plain = value
    order = math.log10(2)
    one = [math.log10(spread or _alphabet(c)) for c in value]
    cut = 0  # the last place before which something is left out
    lost = [0]  # how much is left out up to each place
    best = [0.0]
    dates: dict[int, list[tuple[int, float]]] = {}
    period = [0] * 5  # how many characters up to here equal the one a block before
    walk, turns, way = 0, [0], None  # where the walk began; its turns up to each place
    for end in range(1, n + 1):
        last = end - 1
        if last in cuts:
            cut = last
            lost[last] += cuts[last]
        lost.append(lost[last])
        for kind, ways in _DATES:
            if m := kind.match(value, last):
                dates.setdefault(m.end(), []).append((last, math.log10(ways)))
        # brute force, one character more, and what is left out before it
        low_cost = best[last] + one[last] * (1 + cuts.get(last, 0))
        for start, cost in dates.pop(end, ()):
            if start >= cut:
                low_cost = min(low_cost, best[start] + cost + order)
        # words
        for start in range(max(cut, end - _LONGEST), end - 2):
            word = plain[start:end]
            rank = _RANK.get(word)
            if rank is None:
                rank = _RANK.get(word[::-1])
                rank = rank and 2 * rank
            if rank:
                raw = value[start:end]
                variants = (1 if raw.islower() else 2 if raw.isupper() or raw.istitle() else 2 ** sum(x.isupper() for x in raw)) * (1 if low[start:end] == word else 4)
                low_cost = min(low_cost, best[start] + math.log10(rank * variants + 1) + order)
        going = math.inf
        # repeats of one character, or of a block of up to four
        for block in (1, 2, 3, 4):
            period[block] = period[block] + 1 if last >= block and value[last] == value[last - block] else 0
            if not period[block]:
                continue
            run = end - block - period[block]
            once = sum(one[end - block : end]) if spread else sum(math.log10(_alphabet(x)) for x in value[end - block : end])
            for start in range(run, min(run + HEAD, end - block)):
                going = min(going, best[start] + once)
                if (end - start) % block == 0 and end - start >= max(3, 2 * block):
                    times = (end - start + lost[last] - lost[start]) // block
                    low_cost = min(low_cost, best[start] + once + math.log10(times) + order)
        # keyboard walks
        step = _TOUCH.get((low[last - 1], low[last])) if last and last != cut else None
        if step:
            turns.append(turns[-1] + (way is not None and step != way))
            way = step
            for start in range(walk, min(walk + HEAD, last)):
                # the first step is no turn
                cost = best[start] + math.log10(47 * (end - start)) + (turns[end] - turns[start + 2]) * math.log10(4) / 4 + order
                going = min(going, cost)
                if end - start >= 3:
                    low_cost = min(low_cost, cost)
        else:
            walk, way = last, None
            turns.append(turns[-1])
        best.append(low_cost)
        if min(going, *best[-_LONGEST:]) >= CEILING:
            return CEILING
    return min(CEILING, best[n])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    out = []
    low = text.lower()
    if any(h in low for h in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def all_spans(text: str, base: list[tuple[int, int, int]], min_log10: float = MIN_LOG10) -> tuple[list[tuple[int, int, int]], float]:
    """Base spans and those that the method adds, sorted; and the dearest value's cost."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return base, 0.0
    added, dearest = [], 0.0
    for m in _CONTEXT.finditer(text):
        a, b = m.span(1)
        value = m[1].rstrip(".:!?")
        b = a + len(value)
        if len(value) < MIN_VALUE:
            continue
        cost = guess_cost(value)
        dearest = max(dearest, cost)
        if cost >= min_log10 and not any(s <= a and b <= e for s, _, e in base):
            added.append((a, 3, b))
    return sorted(base + added), dearest


def redact(text: str, spans: list[tuple[int, int, int]], mask: str = MASK) -> str:
    """The text with every span, overlapping ones as one, replaced by the mask."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, log10_guesses double, clean string"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_log10: float = MIN_LOG10) -> DataFrame:
    """The digest of each row and `clean`, its text with every span masked (null where it has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string()]
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                base = base_spans(text)
                spans, cost = all_spans(text, base, min_log10)
                n = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
                rows.append((doc, *n[:3], hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(spans), n[3], cost, redact(text, spans) if spans else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)
    return out.withColumnRenamed("id", id_col)


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", min_log10: float = MIN_LOG10) -> DataFrame:
    """`docs`, all rows and columns, with every span masked; `length_col`, if there is one, follows the new text."""
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sizes = None if length is None else batch.column(length).to_pylist()
            for k, text in enumerate(texts):
                spans, _ = all_spans(text, base_spans(text), min_log10) if text else ([], 0.0)
                if spans:
                    texts[k] = redact(text, spans)
                    if sizes is not None:
                        sizes[k] = len(texts[k])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if sizes is not None:
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)

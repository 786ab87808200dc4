"""Secret scans: fixed patterns, and strings that tokenize badly.

Random strings have few characters per token under a byte-pair vocabulary, since
their letters seldom follow each other in the texts it was made from. Runs of key
characters are tokenized; those with a low ratio are reported unless they are a
known digest or identifier. Spans are in code points of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from homestats.llm.common import cached

# The base patterns, their least sizes, and their order in a listing.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24

#: What the token-efficiency test looks at: runs of key characters, and of these with punctuation.
KEY_CHARS = "A-Za-z0-9+/_=-"
MARKS = "!@#$%^&*()~"
#: The test's least length, and the most characters per token of strings with letters of one case or digits alone, and of others.
RUN_CHARS, ONE_CASE_RATIO, RATIO = 16, 1.9, 2.0
# Digests by their hexadecimal length (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512),
# Subresource Integrity strings, and identifiers that are random by design.
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_CHARS = frozenset((32, 40, 56, 64, 96, 128))
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|sha(?:1|224|256|384|512)[-_=].*"
    r"|[0-9_+/=-]+"  # numbers, dates, rules
    r"|(.)\1*)"
)

#: Names and paths are joined to a secret by these.
PIECE = re.compile(r"[^=/_-]+")
# Fixed value: known strings inside a run: UUIDs, and named digests of their whole length in hexadecimal or base 64.
KNOWN_PART = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])|"
    + "|".join(
        rf"sha{n}[-_=](?:[0-9a-fA-F]{{{n_hex}}}|[A-Za-z0-9+/_-]{{{n_64}}}={{0,2}})(?![A-Za-z0-9+])"
        for n, n_hex, n_64 in ((1, 40, 27), (224, 56, 38), (256, 64, 43), (384, 96, 64), (512, 128, 86))
    )
)

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"

_HEX_TABLE = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))
_HEX_RUN = b"1" * HEX_CHARS


@dataclass(frozen=True)
class RunTest:
    """What counts as a random string: the parameters of the token-efficiency test.

    ``min_chars`` is the least length. Strings of at most ``ratio`` characters per token are random if they mix
    at least two of digits, upper-case and lower-case letters; of others at most ``one_case_ratio`` are asked, as rare
    words come close to ``ratio``. Strings with one of ``marks`` must mix all three, since code
    and rules of marks tokenize badly, too; without ``marks`` such strings aren't looked at.
    """

    ratio: float = RATIO
    one_case_ratio: float = ONE_CASE_RATIO
    min_chars: int = RUN_CHARS
    marks: str = MARKS

    @cached_property
    def keys(self) -> re.Pattern:
        return re.compile(f"[{KEY_CHARS}]{{{self.min_chars},}}")

    @cached_property
    def wide(self) -> re.Pattern:
        return re.compile(f"[{re.escape(self.marks)}{KEY_CHARS}]{{{self.min_chars},}}")

    @cached_property
    def table(self) -> bytes:
        return bytes(49 if self.wide.fullmatch(chr(b) * self.min_chars) else 48 for b in range(256))

    def may_match(self, raw: bytes) -> bool:
        return b"1" * self.min_chars in raw.translate(self.table)

    def looks_random(self, run: str, encode) -> bool:
        """Few characters per token, and no known string."""
        if len(run) < self.min_chars or is_known(run):
            return False
        mixed = any(c.isdigit() for c in run) + any(c.islower() for c in run) + any(c.isupper() for c in run[1:])
        ratio = self.ratio if mixed >= 2 else self.one_case_ratio
        return len(run) <= ratio * len(encode(run))


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns; ``raw`` is the text in UTF-8.

    Searches of the raw bytes tell quickly that a pattern can't match.
    """
    out = []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if _HEX_RUN in raw.translate(_HEX_TABLE):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def is_known(run: str) -> bool:
    """A digest or identifier that is random by design."""
    return bool(len(run) in DIGEST_CHARS and DIGEST.fullmatch(run) or KNOWN.fullmatch(run))


def random_parts(run: str, encode, test: RunTest) -> list[tuple[int, int]]:
    """Parts of a run that look random though the run doesn't, as names and paths are joined to them.

    Pieces between ``=``, ``/``, ``_`` and ``-`` score what they have in tokens beyond the ratio; a
    separator loses a character. Parts are the maximal-scoring sequences of pieces, so a
    secret that holds separators stays whole. Known strings belong to no part.
    """
    known = [m.span() for m in KNOWN_PART.finditer(run)]
    groups: list[list[tuple[int, int]]] = [[]]
    for m in PIECE.finditer(run):
        if any(a < m.end() and m.start() < b for a, b in known) or is_known(m[0]) and len(m[0]) in DIGEST_CHARS:
            groups.append([])
        else:
            groups[-1].append(m.span())
    out = []
    for pieces in groups:
        found: list[tuple[int, int, float, float]] = []  # from, to, sum before, sum at the end
        total, at = 0.0, pieces[0][0] if pieces else 0
        for a, b in pieces:
            total -= a - at
            before, start, at = total, a, b
            total += test.ratio * len(encode(run[a:b])) - (b - a)
            if total <= before:
                continue
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][2] >= before:
                    j -= 1
                if j < 0 or found[j][3] >= total:
                    found.append((start, b, before, total))
                    break
                start, before = found[j][0], found[j][2]
                del found[j:]
        for a, b, _, _ in found:
            while b < len(run) and run[b] == "=":  # padding
                b += 1
            if test.looks_random(run[a:b], encode):
                out.append((a, b))
            else:  # a piece alone, if its neighbours hide it
                out += [(c, d) for c, d in pieces if a <= c and d <= b and test.looks_random(run[c:d], encode)]
    return out


def _without(start: int, end: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of ``start..end`` beside some spans, by start."""
    for a, b in spans:
        if a < end and start < b:
            yield start, a
            start = max(start, b)
    yield start, end


def random_spans(text: str, raw: bytes, taken: list[tuple[int, int]], encode, test: RunTest) -> list[tuple[int, int]]:
    """Runs of key characters that look random, or such parts of other runs; known ones left out.

    Words and paths of words tokenize well. What overlaps ``taken`` spans (by start) is cut off a run, and
    what is left is judged by itself, without the separators that joined it. Runs with punctuation are
    judged whole, if no span of theirs has been found.
    """
    if not test.may_match(raw):
        return []
    out = []
    for m in test.keys.finditer(text):
        for a, b in _without(m.start(), m.end(), taken):
            if (a, b) != m.span():
                part = text[a:b]
                a, b = b - len(part.lstrip("=/_-")), a + len(part.rstrip("/_-"))
            if b - a < test.min_chars:
                continue
            run = text[a:b]
            if test.looks_random(run, encode):
                out.append((a, b))
            elif not is_known(run):
                out += [(a + c, a + d) for c, d in random_parts(run, encode, test)]
    if test.marks:
        found = sorted([*taken, *out])
        at = 0
        for m in test.wide.finditer(text):
            run = m[0]
            if not any(c in test.marks for c in run):
                continue
            while at < len(found) and found[at][1] <= m.start():
                at += 1
            if at < len(found) and found[at][0] < m.end():
                continue
            if any(c.isdigit() for c in run) and any(c.islower() for c in run) and any(c.isupper() for c in run) and test.looks_random(run, encode):
                out.append(m.span())
    return out


def scan_text(text: str | None, encode, test: RunTest) -> list[dict]:
    """All spans of a text by start, then kind; random ones overlap no base span."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    base = base_spans(text, raw)
    spans = base + [(a, 3, b) for a, b in random_spans(text, raw, [(s, e) for s, _, e in base], encode, test)]
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]


def load_encoding(rank_path: str, pattern: str):
    """A tiktoken encoding from a file of ranks."""
    import base64

    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def secret_spans(text: Column, rank_path: str, pattern: str, test: RunTest | None = None) -> Column:
    """Spans ``array<struct<kind, start, end>>`` of whole texts, by start and then kind.

    Base kinds are leftmost non-overlapping matches of each pattern (``assign``,
    ``access``, ``hex``), those too short dropped; ``random`` ones are strings that ``test`` (a
    ``RunTest``) takes for random, as whole runs or as parts that names, paths and base spans are joined
    to. Null and empty texts have no spans; repeated rows have equal ones. The result depends on
    the text alone, so other columns, whatever their names, and an empty table need no care.
    """
    test = test or RunTest()

    @F.arrow_udf(SPAN_TYPE)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = cached(("ranks", rank_path), lambda: load_encoding(rank_path, pattern)).encode_ordinary
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for texts in batches:
            yield pa.array([scan_text(t.as_py(), encode, test) for t in texts], kind)

    return scan(text)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Quality rules combined by weak supervision.

Each rule looks at one measure of a text and votes for (1) or against (-1) it, or
abstains (0). Votes are counted per pattern (at most ``3 ** rules`` patterns,
whatever the number of documents), expectation-maximisation estimates from those
counts how often each rule votes which way on good and on bad texts, and a text is
kept if its posterior probability of being good is high enough. The base limits
are applied besides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import fresh, materialize, text_slices, tidy, word_codes

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_bare_words", "n_marked_words", "n_loud_words", "n_echo_words",
)
WINDOW = 3
#: Texts are measured in slices of about this many bytes.
MEASURE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """Votes for a text if ``per * count <= good * base``, against it if ``per * count > bad * base``."""

    name: str
    count: str
    base: str
    good: float
    bad: float


#: Fixed limits. A measure between the two limits, or with nothing to divide by, makes the rule abstain.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.05, 0.30),
    Rule("capitals", "n_upper", "n_letters", 0.15, 0.50),
    Rule("bare_words", "n_bare_words", "n_words", 0.05, 0.25),
    Rule("marked_words", "n_marked_words", "n_words", 0.05, 0.30),
    Rule("loud_words", "n_loud_words", "n_words", 0.05, 0.30),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.10, 0.30),
    Rule("echoes", "n_echo_words", "n_words", 0.02, 0.10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.25, 0.60),
    Rule("long_words", "word_chars", "n_words", 10.0, 20.0),
)


def _repeated_windows(bounds: np.ndarray, codes: np.ndarray, n_words: int) -> np.ndarray:
    """Words of each text that lie in a window of three words found twice or more in that text."""
    n = len(codes)
    out = np.zeros(len(bounds) - 1, np.int64)
    if n < WINDOW:
        return out
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.flatnonzero(doc[WINDOW - 1 :] == doc[: n - WINDOW + 1])
    if not len(first):
        return out
    a, b, c, d = codes[first].astype(np.uint64), codes[first + 1].astype(np.uint64), codes[first + 2].astype(np.uint64), doc[first].astype(np.uint64)
    hashed = a
    for x in (b, c, d):
        hashed = (hashed * np.uint64(0x9E3779B97F4A7C15)) ^ (hashed >> np.uint64(29)) ^ (x + np.uint64(0x7F4A7C15))
    ordered = np.sort(hashed)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    at = np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)
    some = np.flatnonzero(twice[at] == hashed)
    # equal hashes are only a hint: the windows themselves are compared
    order = some[np.lexsort((c[some], b[some], a[some], d[some]))]
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (c[order][1:] == c[order][:-1]) & (d[order][1:] == d[order][:-1])
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    starts = first[order[repeated]]
    covered = np.zeros(n, bool)
    for i in range(WINDOW):
        covered[starts + i] = True
    return np.bincount(doc[covered], minlength=len(out))


def measure_batch(texts: pa.Array) -> pa.StructArray:
    """The measures of each text; a null text has none of anything but its one empty line."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds, codes, words = word_codes(texts)
    n = len(texts)

    def total(per_word: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(per_word[codes], dtype=np.int64)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    def found(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(words, pattern=pattern).to_numpy(zero_copy_only=False).astype(np.int64)

    letters = found(r"\p{L}")
    lines = pc.split_pattern(texts, "\n")
    line_bounds = lines.offsets.to_numpy().astype(np.int64)
    line_codes = lines.values[line_bounds[0] : line_bounds[-1]].dictionary_encode()
    line_bounds = line_bounds - line_bounds[0]
    has_word = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(line_codes.dictionary)), 0).to_numpy(zero_copy_only=False)
    line_doc = np.repeat(np.arange(n), np.diff(line_bounds))
    code = line_codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = has_word[code] if len(code) else np.zeros(0, bool)
    distinct = np.unique(line_doc[real] * max(1, len(has_word)) + code[real])
    n_lines = np.bincount(line_doc[real], minlength=n)
    n_distinct = np.bincount(distinct // max(1, len(has_word)), minlength=n)

    doc = np.repeat(np.arange(n), np.diff(bounds))
    echo = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    columns = {
        "n_words": np.diff(bounds),
        "word_chars": total(pc.utf8_length(words).to_numpy(zero_copy_only=False)),
        "n_symbols": total(found(r"[#*$%&|<>]")),
        "n_dup_lines": n_lines - n_distinct,
        "n_repeat_words": _repeated_windows(bounds, codes, len(words)),
        "n_lines": n_lines,
        "n_upper": total(found(r"\p{Lu}")),
        "n_letters": total(letters),
        "n_bare_words": total((letters == 0).astype(np.int64)),
        "n_marked_words": total((found(r"[#*$%&|<>]{2}") > 0).astype(np.int64)),
        "n_loud_words": total(found(r"!!+[^\p{L}]*$")),
        "n_echo_words": np.bincount(doc[1:][echo], minlength=n),
    }
    return pa.StructArray.from_arrays([pa.array(columns[m].astype(np.int64)) for m in MEASURES], list(MEASURES))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
@tidy
def measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A struct of the measures of whole texts (null: as empty)."""
    for texts in batches:
        parts = [measure_batch(texts[a:b]) for a, b in text_slices(texts, MEASURE_BYTES)]
        yield pa.concat_arrays(parts) if parts else measure_batch(texts)


def votes(m) -> list[Column]:
    """Each rule's vote, from measures that ``m(name)`` gives as columns."""

    def vote(r: Rule) -> Column:
        count, base = m(r.count).cast("double"), m(r.base).cast("double")
        return F.when(base <= 0, 0).when(count <= base * r.good, 1).when(count > base * r.bad, -1).otherwise(0)

    return [vote(r) for r in RULES]


def votes_of(m: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Each rule's vote on some texts, as ``votes`` has it."""
    return [
        np.where(m[r.base] <= 0, 0, np.where(m[r.count] <= m[r.base] * r.good, 1, np.where(m[r.count] > m[r.base] * r.bad, -1, 0)))
        for r in RULES
    ]


#: So many votes against a text make it an example of a bad one.
ANCHOR = 2
#: How reliable a single vote against a text is held to be before any is estimated.
ACCURACY = 0.8


@dataclass(frozen=True)
class LabelModel:
    """A class of good texts and kinds of bad ones: the share of each, and how its texts are voted on."""

    #: Log of a class's share; the first is the good one.
    shares: tuple[float, ...]
    #: ``votes[class][rule][vote + 1]``: log of P(vote | class)
    votes: tuple[tuple[tuple[float, float, float], ...], ...]

    def p_good(self, ballots: list[np.ndarray]) -> np.ndarray:
        """Probability that a text is good, from the rules' votes on texts."""
        log_votes = np.array(self.votes)
        joint = np.repeat(np.array(self.shares)[None, :], len(ballots[0]), 0)
        for rule, vote in enumerate(ballots):
            joint += log_votes[:, rule, vote.astype(np.int64) + 1].T
        odds = np.exp(joint - joint.max(1, keepdims=True))
        return odds[:, 0] / odds.sum(1)

    def posterior(self, ballots: list[Column]) -> Column:
        """The same of columns."""
        p_good = self.p_good

        @F.arrow_udf(T.DoubleType())
        def evaluate(cast: pa.Array) -> pa.Array:
            return pa.array(p_good([v.to_numpy(zero_copy_only=False) for v in cast.flatten()]), pa.float64())

        return evaluate(F.struct(*[b.alias(f"v{i}") for i, b in enumerate(ballots)]))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smoothing: float = 0.5) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    Texts are bad in different ways, so besides the good class there is a kind of
    bad text per rule, if any text that it votes against. Within a class the rules' votes are taken
    as independent. Patterns with no vote against anchor the good class, those with
    ``ANCHOR`` or more against it the bad kinds; the others are first held to be bad
    with probability ``ACCURACY`` and then estimated. Probabilities are smoothed by
    ``smoothing`` votes of each kind. Without documents the model knows nothing:
    every text counts as good.
    """
    rules = patterns.shape[1] if patterns.ndim == 2 else len(RULES)
    even = tuple((float(np.log(1 / 3)),) * 3 for _ in range(rules))
    if not len(counts):
        return LabelModel((0.0,), (even,))
    weight = counts.astype(np.float64)
    indicator = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(np.float64)  # pattern, rule, vote
    against = patterns < 0
    n_against = against.sum(1)
    may_be_good, may_be_bad = n_against < ANCHOR, n_against > 0
    kinds = np.flatnonzero((weight[:, None] * against).sum(0) > 0)
    belief = np.zeros((len(weight), 1 + len(kinds)))
    belief[:, 0] = np.where(may_be_bad, np.where(may_be_good, 1 - ACCURACY, 0.0), 1.0)
    belief[:, 1:] = against[:, kinds] / np.maximum(n_against, 1)[:, None] * (1 - belief[:, :1])
    allowed = np.concatenate([may_be_good[:, None], np.repeat(may_be_bad[:, None], len(kinds), 1)], axis=1)
    for _ in range(rounds):
        mass = np.einsum("p,pk,prv->krv", weight, belief, indicator) + smoothing
        votes = np.log(mass / mass.sum(2, keepdims=True))
        members = weight @ belief + smoothing
        shares = np.log(members / members.sum())
        joint = shares + np.einsum("prv,krv->pk", indicator, votes)
        joint = np.where(allowed, joint, -np.inf)
        updated = np.exp(joint - joint.max(1, keepdims=True))
        updated /= updated.sum(1, keepdims=True)
        change, belief = np.abs(updated - belief).max(), updated
        if change < 1e-9:
            break
    return LabelModel(
        tuple(float(x) for x in shares), tuple(tuple(tuple(float(x) for x in rule) for rule in kind) for kind in votes)
    )


def estimate(measured: DataFrame, column: str | None = None) -> LabelModel:
    """Fit the label model on all rows that pass the base limits; ``column`` names a struct of measures, if they are in one."""
    names = [f"v{i}" for i in range(len(RULES))]
    get = (lambda x: F.col(f"`{column}`.{x}")) if column else F.col
    counted = measured.filter(~base_failed(get)).select(*[v.alias(n) for v, n in zip(votes(get), names, strict=True)]).groupBy(*names).count()
    rows = counted.orderBy(*names).collect()  # at most 3 ** rules rows, whatever the input
    patterns = np.array([[r[n] for n in names] for r in rows], np.int64).reshape(len(rows), len(names))
    return fit_label_model(patterns, np.array([r["count"] for r in rows], np.int64))


def base_failed(m) -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (m("n_words") < 50) | (m("n_repeat_words") * 100 > m("n_words") * 50)


def assess(docs: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, all measures, ``base_failed``, ``p_good`` and ``kept`` of each row.

    ``kept`` is false for texts that fail the base limits, else whether the posterior
    probability of being good reaches ``threshold``. Null and empty texts have no
    words and fail. Repeated rows get equal results; an empty table gives no rows.
    """
    s = fresh("measures")
    measured = docs.select(F.col(doc_id), measures(F.col(text)).alias(s)).select(doc_id, f"{s}.*")
    measured = materialize(measured, "quality-measures")
    model = estimate(measured)
    failed = base_failed(F.col)
    return measured.select(
        "*", failed.alias("base_failed"), model.posterior(votes(F.col)).alias("p_good")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with their own columns."""
    model = estimate(materialize(docs.select(measures(F.col(text)).alias("m")).select("m.*"), "quality-measures"))
    p_good = model.p_good

    @F.arrow_udf(T.BooleanType())
    @tidy
    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [np.empty(0, bool)]
            for a, b in text_slices(texts, MEASURE_BYTES):
                measured = measure_batch(texts[a:b])
                m = dict(zip(MEASURES, (c.to_numpy(zero_copy_only=False) for c in measured.flatten()), strict=True))
                parts.append(~base_failed(m.__getitem__) & (p_good(votes_of(m)) >= threshold))
            yield pa.array(np.concatenate(parts))

    return docs.filter(good(F.col(text)))

"""Operator 1 - quality rules by tokeniser fertility.

Every word is spelled by public vocabularies as if a space preceded it. Per text
and vocabulary this gives characters per token, the share of byte-fallback tokens
and the entropy (bits) of the text's token distribution. A text is rejected where a
figure leaves the band of its script under every vocabulary that judges the script:
one that does not know a language's letters spells clean text finely and has no veto.
Symbols strewn through the words of a text are no characters that its tokens stand for.
Base rules on words and repeats come first.

One pass over the rows, no shuffle: distinct words are encoded once per worker, so
the cost per text is a few vectorised passes over its UTF-8 bytes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.scratch import small_batches
from quarry.llm.textwords import Words, among, mix, pieces, window_hashes
from quarry.llm.vocab import WordTokens, encoder, fallback_ids, per_worker, public_path

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True

#: Script of a character, by the first code point of each block that matters here.
#: (start, script); characters before the first entry and unlisted blocks are "common".
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "common"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "common"), (0xF900, "han"), (0xFB00, "common"), (0x20000, "han"), (0x30000, "common"),
]


@dataclass(frozen=True)
class Band:
    """Texts below ``min_chars_per_token``, above ``max_fallback`` or outside the entropy band are rejected.

    The least characters per token fall with the share of characters outside ASCII (by
    ``accent_slope``) and of ASCII punctuation (``punctuation_slope``), down to
    ``floor_chars_per_token``. With the share outside ASCII, the fallback allowed rises by
    ``fallback_slope`` and the entropy floor falls by ``entropy_slope`` (letters spelt by bytes
    or combining marks repeat few tokens).
    """

    min_chars_per_token: float
    max_chars_per_token: float
    max_fallback: float
    min_entropy: float
    accent_slope: float = 0.0
    punctuation_slope: float = 0.0
    floor_chars_per_token: float = 0.0
    fallback_slope: float = 0.0
    entropy_slope: float = 0.0


#: Bands per script, or per vocabulary and script ("piece:latin"); None: the vocabulary does not judge the script,
#: as it spells prose and random letters alike. The least characters a token lie between those of prose (Article 1
#: of the human rights declaration) and of uniformly random letters of the script, both measured:
#:
#:   ==========  ====================  ====================
#:   script      multi: prose, random  piece: prose, random
#:   ==========  ====================  ====================
#:   latin       4.15 (en)      1.49   4.15 (en)      1.59
#:   cyrillic    1.14 - 2.81    1.16   1.27 - 2.21    1.11
#:   greek       1.70           1.05   0.86           0.85
#:   hebrew      1.49           1.07   0.83           0.86
#:   arabic      1.23 - 1.49    0.89   0.77 - 0.90    0.78
#:   devanagari  0.78           0.55   0.78 - 0.83    0.52
#:   bengali     0.43           0.45   0.76           0.48
#:   tamil       1.09           0.69   0.88           0.45
#:   thai        1.02           0.66   0.96           0.63
#:   han         0.71 - 0.90    0.45   0.72 - 0.98    0.33
#:   kana        1.05           0.79   0.92           0.56
#:   hangul      1.05           0.43   0.76           0.32
#:   ==========  ====================  ====================
#:
#: Latin letters with a fifth of Vietnamese ones, at random, give 1.26 and 1.26, with three quarters 0.90 and 0.82.
#: Lowest Cyrillic prose is Mongolian, which one of the two vocabularies knows; lowest Han prose is classical Chinese.
DEFAULT_BANDS: dict[str, Band | None] = {
    "latin": Band(1.55, 8.0, 0.15, 5.0, 1.0, 0.7, 1.12, 1.0, 4.0),
    "piece:latin": Band(1.65, 8.0, 0.15, 5.0, 1.1, 0.85, 1.12, 1.0, 4.0),
    "cyrillic": Band(1.22, 8.0, 0.30, 4.0),
    "greek": Band(1.35, 8.0, 0.30, 4.0), "piece:greek": None,
    "hebrew": Band(1.25, 8.0, 0.30, 4.0), "piece:hebrew": None,
    "arabic": Band(1.08, 8.0, 0.30, 4.0), "piece:arabic": None,
    "devanagari": Band(0.65, 8.0, 0.40, 3.0), "piece:devanagari": Band(0.64, 8.0, 0.40, 3.0),
    "bengali": None, "piece:bengali": Band(0.60, 8.0, 0.45, 3.0),
    "tamil": Band(0.85, 8.0, 0.30, 3.0), "piece:tamil": Band(0.62, 8.0, 0.45, 3.0),
    "thai": Band(0.82, 8.0, 0.30, 3.0), "piece:thai": Band(0.78, 8.0, 0.40, 3.0),
    "han": Band(0.60, 8.0, 0.45, 3.0), "piece:han": Band(0.55, 8.0, 0.70, 3.0),
    "kana": Band(0.88, 8.0, 0.40, 3.0), "piece:kana": Band(0.68, 8.0, 0.50, 3.0),
    "hangul": Band(0.65, 8.0, 0.45, 3.0), "piece:hangul": Band(0.50, 8.0, 0.60, 3.0),
    "common": Band(0.6, 8.0, 0.60, 2.5),
    "*": Band(0.25, 8.0, 1.0, 2.5),
}


@dataclass(frozen=True)
class Rules:
    """Parameters of the rules. ``vocabularies`` maps a column prefix to a vocabulary file.

    The entropy floor is that of texts with at least ``entropy_tokens`` tokens;
    a shorter text cannot spread over many tokens.

    Where at least ``accented_percent`` of the characters lie outside ASCII, the vocabularies may know
    none of the language's letters. Such a text is not rejected for few characters per token if words of
    three or more characters that it uses again hold ``recurring_percent`` of its characters, as in any
    any language; random characters hardly recur.

    Where more than ``glued_percent`` of the characters are symbols (``#*$%&|<>``) inside words that also have
    letters or digits, those symbols count neither as characters that tokens stand for nor as punctuation: source
    code has at most 8 of 100 characters there, words with symbols strewn on them 25 and more.
    """

    min_words: int = 50
    repeat_window: int = 3
    max_repeat_percent: int = 50
    entropy_tokens: int = 100
    accented_percent: int = 10
    recurring_percent: int = 15
    glued_percent: int = 10
    vocabularies: dict[str, str] = field(default_factory=lambda: {
        "multi": public_path("byte_bpe_multi_50k.tiktoken"), "piece": public_path("piece_bpe_32k.model")})
    bands: dict[str, Band | None] = field(default_factory=lambda: dict(DEFAULT_BANDS))


def _script(text: str | None) -> str:
    """The script with most letters of the whole text ("common" without letters)."""
    if not text:
        return "common"
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else "common"
    letters = "".join(c for c in set(text) if c.isalpha())
    if letters and max(letters) < "\u0370":
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.array([s for s, _ in SCRIPTS], np.uint32)
    kinds, counts = np.unique(points, return_counts=True)
    tally: dict[str, int] = {}
    for at, point, n in zip(np.searchsorted(starts, kinds, side="right") - 1, kinds, counts, strict=True):
        if chr(point).isalpha():
            name = SCRIPTS[at][1] if at >= 0 else "common"
            tally[name] = tally.get(name, 0) + int(n)
    found = max(sorted(tally), key=lambda k: tally[k]) if tally else "common"
    if found in ("hebrew", "arabic"):  # pointed text is spelled mark by mark: it has no band of its own
        marks = sum(int(n) for point, n in zip(kinds, counts, strict=True) if unicodedata.category(chr(point)) == "Mn")
        return "other" if 10 * marks >= tally[found] else found
    return found


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x and x.strip("\t\n\x0b\x0c\r ")]
    return len(lines) - len(set(lines))


def _repeat_words(words: Words, h: np.ndarray, k: int) -> np.ndarray:
    """Per text, the words inside ``k``-word windows that occur twice or more in that text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(words.n_texts, np.int64)
    doc = words.text_of_word()
    whole = doc[:n] == doc[k - 1:]
    key = mix(window_hashes(h, k) + doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key[whole])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    again = whole & among(key, twice)
    covered = np.zeros(len(h), dtype=bool)
    for j in range(k):
        covered[j:j + n] |= again
    return np.diff(np.searchsorted(np.flatnonzero(covered), words.first))


def _recurring_chars(words: Words, h: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per text, the characters of its words of three or more characters that occur twice or more in it."""
    doc = words.text_of_word()
    key = mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    again = among(key, np.unique(ordered[1:][ordered[1:] == ordered[:-1]])) & (length >= 3)
    return np.diff(np.concatenate([[0], np.cumsum(np.where(again, length, 0))])[words.first])


def _glued_symbols(words: Words) -> np.ndarray:
    """Per text, the symbols inside words that also have letters or digits."""
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[words.data])])
    letters = np.concatenate([[0], np.cumsum(words.inside & ~PUNCTUATION[words.data])])
    per_word = np.where(letters[words.end] > letters[words.start], symbols[words.end] - symbols[words.start], 0)
    return np.diff(np.concatenate([[0], np.cumsum(per_word)])[words.first])


def _token_figures(words: Words, ids: np.ndarray, per_word: np.ndarray, byte_ids: np.ndarray, chars: np.ndarray):
    """Tokens, characters per token, fallback share and entropy of every text (0 without tokens)."""
    ends = np.concatenate([[0], np.cumsum(per_word)])
    cuts = ends[words.first]
    tokens = np.diff(cuts)
    some = np.maximum(tokens, 1)
    fallback = np.diff(np.searchsorted(np.flatnonzero(byte_ids[ids]), cuts))
    doc = np.repeat(np.arange(words.n_texts), tokens)
    key = np.sort((doc.astype(np.int64) << 20) | ids)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    runs = np.diff(np.concatenate([new, [len(key)]])).astype(np.float64)
    plogp = np.bincount(key[new] >> 20, weights=runs * np.log2(runs), minlength=words.n_texts) if len(key) \
        else np.zeros(words.n_texts)
    entropy = np.where(tokens > 0, np.log2(some) - plogp / some, 0.0)
    return tokens, np.where(tokens > 0, chars / some, 0.0), fallback / some, np.maximum(entropy, 0.0)


def _spelled(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encode words as if a space preceded each (SentencePiece puts that space itself)."""
    encode = encoder(path)
    return encode if path.endswith(".model") else lambda texts: encode([" " + t for t in texts])


NEW_COLUMNS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
               ("n_repeat_words", "long"), ("base_failed", "boolean"), ("script", "string")]
PER_VOCABULARY = [("tokens", "long"), ("chars_per_token", "double"), ("fallback_share", "double"),
                  ("token_entropy", "double")]


def output_columns(rules: Rules) -> list[tuple[str, str]]:
    return [*NEW_COLUMNS, *((f"{v}_{c}", t) for v in rules.vocabularies for c, t in PER_VOCABULARY),
            ("reason", "string"), ("kept", "boolean")]


NO_BAND = Band(0.0, 0.0, 0.0, 0.0)


def _band(rules: Rules, vocabulary: str, script: str) -> Band | None:
    for key in (f"{vocabulary}:{script}", script):
        if key in rules.bands:
            return rules.bands[key]
    return rules.bands["*"]


def _assess(texts: pa.Array, rules: Rules) -> list[pa.Array]:
    words = Words(texts)
    h = words.hashes()
    strings: Sequence[str | None] = texts.to_pylist()
    first_bytes = words.inside & ((words.data & 0xC0) != 0x80)
    chars = words.per_text(first_bytes)
    n_words = words.counts
    repeats = _repeat_words(words, h, rules.repeat_window)
    failed = (n_words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n_words)
    scripts = [_script(s) for s in strings]
    out = [n_words, chars, words.per_text(SYMBOLS[words.data]), np.array([_dup_lines(s) for s in strings], np.int64),
           repeats, failed, scripts]
    reason = np.where(failed, "base", "").astype(object)
    some = np.maximum(chars, 1)
    accents = words.per_text(first_bytes & (words.data >= 0x80)) / some
    glued = _glued_symbols(words)
    glued = np.where(100 * glued > rules.glued_percent * chars, glued, 0)
    marks = (words.per_text(words.inside & PUNCTUATION[words.data]) - glued) / some
    so_far = np.concatenate([[0], np.cumsum(first_bytes)])
    recurring = _recurring_chars(words, h, so_far[words.end] - so_far[words.start])
    language = (100 * accents >= rules.accented_percent) & (100 * recurring >= rules.recurring_percent * some)
    paths = list(rules.vocabularies.values())
    known = per_worker(f"words:{paths}", lambda: WordTokens([_spelled(p) for p in paths]))
    slots = known.lookup(h, words.strings) if paths else None
    against: dict[str, list[np.ndarray]] = {}
    judged = np.full(len(scripts), None, dtype=object)  # the first vocabulary that judges the text's script
    for v, (prefix, path) in enumerate(rules.vocabularies.items()):
        byte_ids = per_worker(f"bytes:{path}", lambda path=path: fallback_ids(path))
        ids, per_word = known.expand(slots, v)
        tokens, ratio, share, entropy = _token_figures(words, ids, per_word, byte_ids, chars)
        out += [tokens, ratio, share, entropy]
        bands = [_band(rules, prefix, s) for s in scripts]
        judges = np.array([b is not None for b in bands], dtype=bool)
        judged[judges & (judged == None)] = prefix  # noqa: E711 - elementwise
        least, high, most, floor, accent, mark, lowest, more, less = (
            np.array([getattr(b or NO_BAND, f.name) for b in bands]) for f in fields(Band))
        low = np.maximum(least - accent * accents - mark * marks, np.minimum(least, lowest))
        worth = ratio * (1 - glued / some)
        for what, bad in (("chars_per_token", ((worth < low) & ~language) | (ratio > high)),
                          ("fallback_share", share > most + more * accents),
                          ("token_entropy", (tokens >= rules.entropy_tokens) & (entropy < floor - less * accents))):
            against.setdefault(what, []).append(bad | ~judges)
    for what, verdicts in against.items():  # all that judge agree; the reason bears the first one's name
        bad = (reason == "") & (judged != None) & np.logical_and.reduce(verdicts)  # noqa: E711
        reason[bad] = [f"{v}_{what}" for v in judged[bad]]
    kept = reason == ""
    return [*(pa.array(x) for x in out), pa.array([r or None for r in reason], pa.string()), pa.array(kept)]


def assess(docs: DataFrame, text: str = "text", rules: Rules | None = None, only_kept: bool = False) -> DataFrame:
    """``docs`` with the figures and verdict of every row (``output_columns``), rows unchanged.

    * Null and empty texts have 0 words: every figure is 0, ``base_failed`` is true, ``kept`` false.
    * Very long texts are taken whole; a task holds one of them at a time.
    * Rows are judged one by one: repeated rows and ids give repeated, equal verdicts.
    * An empty table gives an empty table with the same columns.
    * An input column with the name of an output column is replaced; all others are kept.
    * ``only_kept`` returns the kept rows with the input's own columns alone.
    """
    rules = rules or Rules()
    small_batches(docs.sparkSession)
    added = output_columns(rules)
    names = {c for c, _ in added}
    carried = [f for f in docs.schema.fields if only_kept or f.name not in names]
    schema = T.StructType(carried if only_kept else carried + T._parse_datatype_string(
        ", ".join(f"{c} {t}" for c, t in added)).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = _assess(batch.column(text), rules)
            if only_kept:
                yield batch.filter(found[-1])
                continue
            own = [batch.column(f.name) for f in carried]
            yield pa.RecordBatch.from_arrays([*own, *found], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)



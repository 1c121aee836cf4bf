"""Quality rules: base counts of a text, and how a public vocabulary takes it.

Fertility: characters per token, share of byte-fallback tokens and entropy of the tokens
(bits, Miller-Madow corrected, so that short texts compare with long ones), against bands
of the document's language. Fluent text is cut into long, varied pieces. A text fails when
characters per token or the byte share leave their wide band, or when both characters per
token and entropy lie below the language's lower bands: either alone also befalls clean text.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm.common import kept, table
from fluxwatch.llm.tokens import LONGEST, REMEMBERED, SEGMENT_CHARS, WIDE, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\v\f\r"
#: White space to str.split() that does not end a word here.
INSIDE_WORDS = re.compile(f"[\x1c-\x1f\x85\xa0{WIDE}]")
SYMBOLS = "#*$%&|<>"
#: Shortest text, in tokens, that the language bands judge; how far the entropy band gives way for few tokens.
LEAST_TOKENS, GIVE = 128, 40.0
#: Language: lowest and highest characters per token, highest byte share, and the joint lower
#: bands of characters per token and entropy. Set from labelled rows; a null or other language takes the band
#: of its text's script: LATIN, fitted on the labelled rows of all languages together, or "", which no labelled row supports.
BANDS = {
    "en": (1.3, 6.0, 0.10, 2.10, 6.42),
    "de": (1.3, 6.0, 0.10, 2.12, 6.35),
    "fr": (1.3, 6.0, 0.10, 1.95, 6.33),
    "es": (1.3, 6.0, 0.10, 1.90, 6.36),
    "latin": (1.0, 12.0, 0.30, 2.10, 6.36),
    "": (0.0, 12.0, 0.90, 1.60, 5.00),
}
LATIN = "latin"
#: Letters, and letters of other scripts than Latin.
LETTER, OTHER = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_\u0000-\u024f\u1e00-\u1eff]+")
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_tokens long, chars_per_token double, byte_share double, entropy double, kept boolean"
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text) if INSIDE_WORDS.search(text) else text.split()


def repeated(words: list[str], span: int = 5) -> int:
    """Words that lie in a window of ``span`` words found twice or more, the first one included."""
    n = len(words)
    if n <= span:
        return 0
    marks = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    windows = np.zeros(n - span + 1, np.uint64)
    for i in range(span):
        windows *= np.uint64(0x9E3779B97F4A7C15)
        windows += marks[i:n - span + 1 + i] ^ (marks[i:n - span + 1 + i] >> np.uint64(29))
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + span, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


class Pieces:
    """Token ids of words under a sentence-piece model, remembered per Python worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.known: dict[str, bytes] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        """Ids of the words, each encoded by itself."""
        known = self.known
        try:
            joined = b"".join(map(known.__getitem__, words))
        except KeyError:
            met = list({w for w in words if w not in known})
            new = {w: np.array(ids, "<u2").tobytes() for w, ids in zip(met, self.model.encode(met, num_threads=1))}
            joined = b"".join([known[w] if w in known else new[w] for w in words])
            if len(known) + len(new) > REMEMBERED:
                known.clear()
            known.update((w, ids) for w, ids in new.items() if len(w) <= LONGEST)
        return np.frombuffer(joined, "<u2")

    def measure(self, words: list[str]) -> tuple[int, float, float]:
        """Tokens, byte share, entropy; a long text is counted in parts."""
        if len(words) <= SEGMENT_CHARS:
            tokens, n = np.unique(self.ids(words), return_counts=True)
        else:
            total = np.zeros(len(self.bytes), np.int64)
            for i in range(0, len(words), SEGMENT_CHARS):
                total += np.bincount(self.ids(words[i:i + SEGMENT_CHARS]), minlength=len(total))
            tokens = np.flatnonzero(total)
            n = total[tokens]
        size = int(n.sum())
        if not size:
            return 0, 0.0, 0.0
        entropy = math.log2(size) - float((n * np.log2(n)).sum()) / size + (len(n) - 1) / (2 * size * math.log(2))
        return size, float(n[self.bytes[tokens]].sum()) / size, entropy


def pieces(path: str) -> Pieces:
    return kept(Pieces, path)


def band_of(text: str, lang: str | None, bands: dict) -> str:
    """The band's name: the language, else Latin unless over half of the letters are of other scripts."""
    if lang in bands and lang not in (LATIN, ""):
        return lang
    if LATIN not in bands:
        return ""
    if text.isascii():
        return LATIN
    letters, others = (len(text) - len(p.sub("", text)) for p in (LETTER, OTHER))
    return "" if 2 * others > letters else LATIN


def verdict(lang: str | None, chars: int, tokens: int, share: float, entropy: float, bands: dict) -> bool:
    low, high, most, joint, least = bands.get(lang or "", bands[""])
    if not tokens:
        return False
    ratio = chars / tokens
    if not low <= ratio <= high or share > most:
        return False
    return tokens < LEAST_TOKENS or ratio >= joint or entropy >= least - GIVE / tokens


def judge(text: str | None, lang: str | None, use: Pieces, bands: dict) -> tuple:
    text = text or ""
    words = words_of(text)
    n, again = len(words), repeated(words)
    failed = n < 10 or 100 * again > 20 * n
    chars = sum(map(len, words))
    tokens, share, entropy = use.measure(words)
    kept = not failed and verdict(band_of(text, lang, bands), chars, tokens, share, entropy, bands)
    return (
        n, chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), again, failed,
        tokens, chars / tokens if tokens else 0.0, share, entropy, kept,
    )


def judged(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", bands: dict | None = None, out: str = "quality") -> DataFrame:
    """``docs`` with a struct ``out`` of counts, fertility and ``kept``, computed in the scan.

    Null and empty texts have no words and fail; a null or unknown language takes the band of
    its text's script. Other columns are untouched, whatever their names; one named ``out`` is replaced.
    """
    chosen = bands or BANDS

    @F.pandas_udf(SCHEMA)
    def measured(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        use = pieces(path)
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        return pd.DataFrame([judge(t, g, use, chosen) for t, g in zip(texts, langs)], columns=names)

    return docs.withColumn(out, measured(F.col(text), F.col(lang)))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return judged(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "quality.*")

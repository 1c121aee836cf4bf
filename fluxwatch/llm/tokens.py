"""Token ids and counts of whole texts, encoded a word at a time through a bounded memory.

The two tokenizer families served split a text into words before any merge, so the ids of
a text are those of its chunks in a row, as long as chunks are cut where no word of the
tokenizer can reach across. Each Python worker remembers the ids of short chunks it has
met; only chunks that are new to it go to the library, in batches of bounded bytes.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm.common import kept, table, utf8_bytes

#: White space as the tokenizers' patterns see it (fixed values: Unicode property White_Space),
#: and the part of it below 256, whose classes match much faster.
NARROW = "\t-\r \x85\xa0"
WIDE = "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE_SPACES = [c for c in map(chr, range(0x1680, 0x3001)) if re.match(f"[{WIDE}]", c)]
#: White space other than blanks and line ends, and two in a row of those: asked for by ``in``, much faster than by a class.
RARE_SPACES, PAIRS = "\t\v\f\r\x85\xa0", ("  ", " \n", "\n ", "\n\n")
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"


def _patterns(space: str) -> dict[str, re.Pattern]:
    """How to cut a text: ``words`` drops white space, ``bytes`` keeps it (one blank or line end
    goes with the word behind it), ``safe`` finds places between two words for long texts.
    A dot or comma behind a letter is cut off, so that fewer chunks differ."""
    word = rf"(?:[^{space},.]++(?:(?<=[{LETTER}])(?=[,.])|[^{space}]*+)|[,.][^{space}]*+)"
    return {
        "words": re.compile(word),
        "bytes": re.compile(rf"[ \n]?{word}|[{space}]+(?![^{space}])|[{space}]"),
        "safe": re.compile(rf"(?<=[^{space}])(?=[ \n][^{space}])"),
        "odd": re.compile(rf"[{space}][{space}]"),
    }


def has_wide(text: str) -> bool:
    return not text.isascii() and any(c in text for c in WIDE_SPACES)


def has_odd(text: str) -> bool:
    """Whether two of white space stand in a row."""
    if has_wide(text) or any(c in text for c in RARE_SPACES):
        return SPLITS[has_wide(text)]["odd"].search(text) is not None
    return any(p in text for p in PAIRS)


SPLITS = {False: _patterns(NARROW), True: _patterns(NARROW + WIDE)}
#: Characters that str.split() takes for white space and the vocabularies do not.
SEPARATORS = "\x1c\x1d\x1e\x1f"

SEGMENT_CHARS = 1 << 20
#: Characters of texts whose new words go to the library together, and times as many where Arrow finds the words that differ.
GROUP_CHARS, ARROW_GROUPS = 1 << 17, 16
BATCH_BYTES = 1 << 20
REMEMBERED, LONGEST = 400_000, 48
#: Words of letters, which are one word to both families' patterns and which only lower-casing normalises; the signs behind them are
#: another one (no apostrophe: some letters go with it). So many different ends are remembered.
LETTERS, SIGNS, ENDS = re.compile(f"[{LETTER}]+"), r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~""", 10_000


def _byte_letters() -> dict[int, int]:
    """The letters byte-level vocabularies write bytes in: printable bytes stand for themselves,
    the others in their order for the code points from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
#: Bytes above ASCII that are written as other letters.
HIGH = re.compile("[" + "".join(re.escape(chr(b)) for b in BYTE_LETTERS if b > 127) + "]")


class Encoder:
    """Ids of texts under one vocabulary file, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path) as f:
            rules = json.load(f)
        kinds = [p["type"] for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [rules["pre_tokenizer"] or {"type": ""}])]
        if kinds == ["ByteLevel"] and rules["normalizer"] is None and not rules["pre_tokenizer"]["add_prefix_space"]:
            self.kind = "bytes"
        elif kinds == ["Split", "ByteLevel"] and rules["pre_tokenizer"]["pretokenizers"][0]["behavior"] == "Removed":
            self.kind = "words"
        else:
            raise ValueError(f"{path}: no safe boundaries are known for its rules")
        added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.special = {k: int(v).to_bytes(4, "little") for k, v in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        # words are remembered here; asking the library's own memory for words that it has never met costs more than it saves
        self.model = self.library.model
        self.model._resize_cache(0)
        # the same model, to which each line is one word, and the tokens that begin a word after a blank ("bytes") or end one ("words")
        self.lines = Tokenizer(self.model)
        self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.blank = " " if self.kind == "bytes" else ""
        self.mark = chr(BYTE_LETTERS[32]) if self.blank else ""
        suffix = rules["model"].get("end_of_word_suffix") or "\n"  # no token has a line end
        vocab = rules["model"]["vocab"]
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        self.edge[[i for t, i in vocab.items() if (t.startswith(self.mark) if self.blank else t.endswith(suffix))]] = True
        self.tails = {"": b""}  # ids of the signs words end with
        self.remembered: int | None = None  # words and chunks of one generation; None: REMEMBERED
        # two generations of each memory: full ones are put behind, what is asked for again comes back
        self.known: dict[str, bytes] = {}  # ids of chunks
        self.known_before: dict[str, bytes] = {}
        self.behind: dict[str, bytes] = {}  # ids of a word with the blank before it, if there is one
        self.behind_before: dict[str, bytes] = {}

    def _by_library(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _encode(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks by the library, in batches of bounded bytes."""
        found: dict[str, bytes] = {}
        batch: list[str] = []
        weight = 0
        for chunk in [*chunks, None]:
            if batch and (chunk is None or weight + 4 * len(chunk) > BATCH_BYTES):
                found.update(zip(batch, self._by_library(batch)))
                batch, weight = [], 0
            if chunk is not None:
                batch.append(chunk)
                weight += 4 * len(chunk)
        return found

    def _simple(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters (behind a blank), which the model gets together, a line each."""
        lines = "\n".join(words)
        if not self.blank:
            lines = lines.lower()
        if not lines.isascii():
            lines = lines.encode().decode("latin-1")
            for c in set(HIGH.findall(lines)):
                lines = lines.replace(c, chr(BYTE_LETTERS[ord(c)]))
        lines = self.mark + lines.replace("\n", "\n" + self.mark)
        ids = np.array(self.lines.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):  # a vocabulary that lacks a letter
            return [array("I", [t.id for t in self.model.tokenize(w)]).tobytes() for w in lines.split("\n")]
        cuts = [*(4 * at).tolist(), 4 * len(ids)] if self.blank else [0, *(4 * at + 4).tolist()]
        body = ids.tobytes()
        return [body[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, words: set[str]) -> None:
        """Remembers words: from the older memory, or from the library. Those of letters go together."""
        behind, before = self.behind, self.behind_before
        again = {word: ids for word, ids in zip(words, map(before.get, words)) if ids is not None}
        behind.update(again)
        letters: dict[str, None] = {}
        ended: list[tuple[str, str, str]] = []
        others: list[str] = []
        for word in words - again.keys() if again else words:
            core = word.rstrip(SIGNS)
            tail = word[len(core):]
            # asked for by itself where it can be: a pattern takes several times as long
            if len(word) > LONGEST or not (core.isalpha() if core.isascii() else LETTERS.fullmatch(core)) or not self._end(tail):
                others.append(word)
            elif not tail:
                letters[core] = None
            else:
                ended.append((word, core, tail))
                if core not in behind:
                    if (ids := before.get(core)) is not None:
                        behind[core] = ids
                    else:
                        letters[core] = None
        if letters:
            behind.update(zip(letters, self._simple([*letters])))
        for word, core, tail in ended:
            behind[word] = behind[core] + self.tails[tail]
        if others:
            find = SPLITS[any(map(has_wide, others))][self.kind].findall
            behind.update(zip(others, self._cut([w if w[:1] == "\n" else self.blank + w for w in others], find)))

    def _end(self, tail: str) -> bool:
        """Whether the ids of these signs are remembered, now at the latest."""
        if tail not in self.tails:
            if len(self.tails) >= ENDS:
                return False
            self.tails[tail] = self._by_library([tail])[0]
        return True

    def _cut(self, texts: list[str], find) -> list[bytes]:
        """Ids of texts, each cut into chunks; chunks not met before go to the library together."""
        known = self.known
        cuts = [find(t) for t in texts]
        new = {c for chunks in cuts for c in chunks if c not in known}
        again = {c: ids for c in new if (ids := self._met(c)) is not None}
        found = self._encode(new - again.keys())
        ids_of = {**again, **found}
        done = [b"".join([known[c] if c in known else ids_of[c] for c in chunks]) for chunks in cuts]
        # a text that is one chunk is remembered by the caller, as a word
        whole = {chunks[0] for chunks in cuts if len(chunks) == 1}
        known.update((c, ids) for c, ids in ids_of.items() if c not in whole and len(c) <= LONGEST)
        return done

    def _met(self, chunk: str) -> bytes | None:
        """Ids of a chunk from the older memory, or from the words behind a blank."""
        if chunk in self.known_before:
            return self.known_before[chunk]
        if self.blank and chunk[:1] != "\n":
            if chunk[:1] != " " or chunk[1:2] == "\n":  # a word that begins with a line end has no blank before it
                return None
            chunk = chunk[1:]
        return self.behind.get(chunk) or self.behind_before.get(chunk)

    def _words(self, text: str) -> tuple[str, list[str]] | None:
        """What no blank stands before, and a text's words as the memory has them; None for a text with uncommon white space."""
        if not self.blank:
            return None if any(c in text for c in SEPARATORS) else ("", text.split())
        if has_odd(text):
            return None
        words = text.replace("\n", " \n").split(" ")
        return words.pop(0), words

    def _first(self, words: list[str]) -> list[bytes]:
        """Ids of words that no blank stands before; all that are new go to the library together."""
        new = [*{w for w in words if w and w not in self.known}]
        found = {"": b""}
        if new:
            found.update(zip(new, self._cut(new, SPLITS[any(map(has_wide, new))][self.kind].findall)))
            self.known.update((w, ids) for w, ids in found.items() if w and len(w) <= LONGEST)
        return [found[w] if w in found else self.known[w] for w in words]

    def _found(self, lists: list[list[str]]) -> list[list[bytes]]:
        """Ids of every word of lists: one look-up a word, and all that are new go to the library together."""
        if len(self.known) + len(self.behind) > (self.remembered or REMEMBERED):
            self.known_before, self.known = self.known, {}
            self.behind_before, self.behind = self.behind, {}
        behind = self.behind
        found = [list(map(behind.get, words)) for words in lists]
        holes = [[i for i, known in enumerate(ids) if known is None] for ids in found]
        new = {words[i] for words, at in zip(lists, holes) for i in at}
        if new:
            self._learn(new)
            for words, ids, at in zip(lists, found, holes):
                for i in at:
                    ids[i] = behind[words[i]]
            for word in [w for w in new if len(w) > LONGEST]:
                del behind[word]
        return found

    def _looked_up(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of lists of words."""
        return [b"".join(ids) for ids in self._found(lists)]

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without uncommon white space. Arrow splits them, so that a word is looked up once for all."""
        if not self.blank:
            return self._looked_up([t.split() for t in texts])
        cuts = [t.replace("\n", " \n").partition(" ") for t in texts]
        first = self._first([cut[0] for cut in cuts])
        lists = pc.split_pattern(pa.array([cut[2] if cut[1] else None for cut in cuts], pa.string()), " ")
        words = lists.values.dictionary_encode()
        if not len(words):
            self._found([])  # the memory's bound
            return first
        body = pa.array(self._found([words.dictionary.to_numpy(zero_copy_only=False).tolist()])[0], pa.binary()).take(words.indices)
        _, ends, ids = body.buffers()
        at = np.frombuffer(ends, np.int32)[lists.offsets.to_numpy()].tolist()
        view = memoryview(ids)
        return [head + view[a:b] for head, a, b in zip(first, at, at[1:])]

    def _plain(self, text: str) -> Iterator[bytes]:
        """The ids of a text without special strings, a segment at a time."""
        split = SPLITS[has_wide(text)]
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > SEGMENT_CHARS and (m := split["safe"].search(text, start + SEGMENT_CHARS)):
                end = m.start()
            segment = text[start:end] if end - start < len(text) else text
            start = end
            if (cut := self._words(segment)) is None:
                yield self._cut([segment], split[self.kind].findall)[0]
                self._looked_up([])  # the memory's bound
            else:
                yield self._first([cut[0]])[0] + self._looked_up([cut[1]])[0]

    def parts(self, text: str) -> Iterator[bytes]:
        """The ids of a text in pieces of bounded size."""
        if self.cut is None or not self.cut.search(text):
            yield from self._plain(text)
            return
        for part in self.cut.split(text):
            if part in self.special:
                yield self.special[part]
            else:
                yield from self._plain(part)

    def ids(self, text: str) -> bytes:
        return b"".join(self.parts(text))

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of every text, null ones counting as empty. Texts of about GROUP_CHARS in all, or ARROW_GROUPS times that, go together."""
        def done() -> Iterator[bytes]:
            fit = [not (len(t) > GROUP_CHARS or self.cut and self.cut.search(t) or (has_odd(t) if self.blank else any(c in t for c in SEPARATORS))) for t in group]
            found = iter(self._together([t for t, fits in zip(group, fit) if fits]))
            for t, fits in zip(group, fit):
                yield next(found) if fits else self.ids(t)

        most = GROUP_CHARS * (ARROW_GROUPS if self.blank else 1)
        group: list[str] = []
        weight = 0
        for text in texts:
            group.append(text or "")
            weight += len(group[-1])
            if weight > most:
                yield from done()
                group, weight = [], 0
        yield from done()

    def count(self, text: str) -> int:
        return sum(map(len, self.parts(text))) // 4


def encoder(path: str, remembered: int | None = None, lasting: bool = False) -> Encoder:
    """The encoder of a file, one at a time in each Python worker, how many words it remembers, and whether for later tasks too."""
    use = kept(Encoder, path, lasting)
    use.remembered = remembered
    return use


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def token_counts(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each whole text; null and empty texts have none.

    Only lengths leave Python. No shuffle; a text longer than a segment is encoded segment
    by segment. An existing column named ``out`` is replaced.
    """
    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        use = encoder(path)
        return pd.Series([use.count(t) if t else 0 for t in texts], dtype="int64")

    return df.withColumn(out, counted(F.col(text)))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", utf8_bytes("text").alias("n_bytes"))
    counted = token_counts(docs, vocabulary("byte_bpe_50k.json")).drop("text")
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)

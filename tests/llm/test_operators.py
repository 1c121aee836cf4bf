"""The operators against brute force on small tables that hold the awkward cases."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fluxwatch.llm import binary, common, embeddings, lines, mixing, packing, quality, sharding, simhash, tokens, toxicity
from fluxwatch.session import run_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE, WORDS, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
PASSAGE = " ".join(f"passage{i}" for i in range(60))
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [
    (1, "Alpha beta gamma.\nsecond line\nSECOND line", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, f"own words first\n{PASSAGE}\ntail one", "en", "a"),
    (5, f"{PASSAGE}\nother tail", "de", "c"),
    (6, LONG, "en", "a"),
    (6, LONG, "en", "a"),
    (7, f"{PASSAGE}\n{PASSAGE}", "xx", "b"),
    (None, f"{PASSAGE}\nno id", "fr", None),
    (8, "<|endoftext|> é ﬁ  double  blanks\r\n\ttabs\x1c\x85x", "es", "a"),
    (9, " ", None, "b"),
    (10, "a b a b a b a b a b a b a b\n" * 3, "en", "c"),
]
DDL = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def bag(rows):
    return collections.Counter(map(tuple, rows))


# --- sharding ---------------------------------------------------------------


def spark_hash(key: str, shard: int) -> int:
    first = xxhash.xxh64_intdigest(key.encode(), 42)
    return xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), first)


def test_shards_follow_the_earliest_clock(docs):
    weights = [1.0, 0.0, 2.5, 1.0]
    found = sharding.shard(docs.withColumn("shard", F.lit("old")), weights=weights).select("doc_id", "shard").collect()
    for doc_id, shard in found:
        key = "null" if doc_id is None else str(doc_id)
        clocks = [(-np.log(((spark_hash(key, i) >> 11) + 0.5) / 2**53) / w, i) for i, w in enumerate(weights) if w]
        assert shard == min(clocks)[1]


def test_a_new_shard_only_takes(spark):
    keys = spark.range(4000).select(F.col("id").alias("doc_id"))
    both = sharding.shard(sharding.shard(keys, weights=[1.0] * 16), weights=[1.0] * 17, out="grown")
    moved = both.where("shard != grown")
    assert moved.where("grown != 16").count() == 0
    assert 120 < moved.count() < 380


def test_slots_have_no_gaps_in_a_hot_shard(spark):
    rows = spark.range(5000, numPartitions=7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 4).alias("shard"))
    for shard, slots in sharding.slots(rows).groupBy("shard").agg(F.collect_list("slot")).collect():
        assert sorted(slots) == list(range(len(slots)))


# --- tokens -----------------------------------------------------------------


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary(name))


@pytest.mark.parametrize("name", [BYTE, WORDS])
@pytest.mark.parametrize("segment", [5, 1 << 20])
def test_ids_equal_the_library(name, segment, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_CHARS", segment)
    pick = np.random.default_rng(5)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "\xa0", "'s", "'ll", ",", ".", "12", "中文", "́", "ﬁ", "Σ", "\x1c", "\x85",
             "<|endoftext|>", "\r\n", " ", "　", "-", "😀", "İ", "word,", "End.\nNext"]
    texts = ["".join(pick.choice(parts, pick.integers(0, 25))) for _ in range(1500)] + [r[1] or "" for r in ROWS]
    use, lib = tokens.Encoder(tokens.vocabulary(name)), library(name)
    for _ in range(2):  # new and remembered
        for text in texts if segment > 5 else texts[:1500]:
            assert use.ids(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    use, lib = tokens.Encoder(tokens.vocabulary(BYTE)), library(BYTE)
    for i in range(0, 3000, 100):
        text = " ".join(f"unusual{j}" for j in range(i, i + 120))
        assert use.count(text) == len(lib.encode(text).ids)
    assert len(use.behind) <= 200


def test_batches_are_bounded_and_settings_come_back(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = spark.range(600, numPartitions=1).select(F.repeat(F.lit("abc def "), F.lit(1000)).alias("text"))
    for rows, size, most in ((500, 4 << 20, 500), (500, 1 << 20, 140)):
        with common.batches_of(spark, rows, size):
            assert texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] <= most
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def letters(i):
    return "".join(chr(97 + int(d)) for d in str(i))


@pytest.mark.parametrize("name", [BYTE, WORDS])
def test_the_memories_have_one_bound(name, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    use, lib = tokens.Encoder(tokens.vocabulary(name)), library(name)
    most = 0
    for i in range(0, 8000, 100):
        text = " ".join(f"{letters(j)}. x{letters(j)}-{j},  y{letters(j)}," for j in range(i, i + 100))
        if i % 200:
            text = text.replace("  ", " ")
        assert use.ids(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        most = max(most, sum(map(len, (use.known, use.known_before, use.behind, use.behind_before))))
    assert most <= 2 * (1000 + 600)  # two generations of the bound, each over it by the words of one text


@pytest.mark.parametrize("name", [BYTE, WORDS])
def test_texts_together_have_the_ids_of_each(name, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_CHARS", 4000)
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    pick = np.random.default_rng(8)
    parts = ["Ärger", "niño", "über.", "été,", "ÀÉÎÕÜ", "ÿ", "ß", "don't", "x-ray.", "3.14", "\n", "\n\n", "  ", "　", "ﬁ", "<|endoftext|>", "q" * 60, "q" * 60 + "."]
    texts = [" ".join(pick.choice([*parts, *(letters(j) for j in range(900))], pick.integers(0, 60))) for _ in range(400)] + [None, "", LONG, " ", "\n"]
    use, lib = tokens.Encoder(tokens.vocabulary(name)), library(name)
    for _ in range(2):
        found = list(use.each(texts))
        assert len(found) == len(texts)
        for text, ids in zip(texts, found):
            assert ids == np.array(lib.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_new_words_of_a_group_go_to_the_library_together(monkeypatch):
    use, asked = tokens.Encoder(tokens.vocabulary(WORDS)), []
    monkeypatch.setattr(use, "_simple", lambda words, simple=use._simple: asked.append(len(words)) or simple(words))
    assert len(list(use.each([f"new {letters(i)}, {letters(i)}z" for i in range(300)]))) == 300
    assert asked == [601]


def test_signs_and_first_words_go_to_the_library_together(monkeypatch):
    use, lib, asked = tokens.Encoder(tokens.vocabulary(BYTE)), library(BYTE), []
    monkeypatch.setattr(use, "_by_library", lambda chunks, whole=use._by_library: asked.append(len(chunks)) or whole(chunks))
    texts = [f"{letters(i)}q {letters(i)}*** É{letters(i)}.&&, {letters(i)}?" for i in range(300)]
    found = list(use.each(texts))
    assert found == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sorted(asked) == [1, 1, 1, 300]  # three ends, and the first words


def test_white_space_in_a_row():
    pick = np.random.default_rng(3)
    parts = [*" \n\t\r\x0b\x0c\x1c\x85\xa0\u1680\u2007\u200b\u2028\u3000", "a", "é", "字", " a", "b ", "b\n"]
    for text in ("".join(pick.choice(parts, pick.integers(0, 7))) for _ in range(5000)):
        white = [c in " \n\t\r\x0b\x0c\x85\xa0\u1680\u2007\u2028\u3000" for c in text]
        assert tokens.has_wide(text) == any(c in "\u1680\u2007\u2028\u3000" for c in text)
        assert tokens.has_odd(text) == any(a and b for a, b in zip(white, white[1:])), repr(text)


def test_a_worker_keeps_its_words_for_later_tasks(spark):
    import os

    import pyarrow as pa
    from pyspark import cloudpickle

    path = tokens.vocabulary(BYTE)
    tokens.encoder(path, 1000, lasting=True).ids("the driver's words")

    def task(batches):
        use = tokens.encoder(path, 1000, lasting=True)
        met = len(use.behind)
        for batch in batches:
            use.ids("some words of a task")
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([met])], ["pid", "met"])

    assert len(cloudpickle.dumps(task)) < 200_000  # without the driver's vocabulary
    rows = spark.range(24, numPartitions=24).mapInArrow(task, "pid long, met long").collect()
    assert sum(r.met == 0 for r in rows) == len({r.pid for r in rows}) < 24

    def gone(batches):
        common.let_go()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._lasting())])], ["n"])

    assert {r.n for r in spark.range(8, numPartitions=8).mapInArrow(gone, "n long").collect()} == {0}
    common.let_go()


def test_token_counts(docs, empty):
    lib = library(BYTE)
    found = tokens.token_counts(docs.withColumn("n_tokens", F.lit("x")), tokens.vocabulary(BYTE)).select("text", "n_tokens").collect()
    assert all(n == len(lib.encode(t or "").ids) for t, n in found)
    assert tokens.token_counts(empty, tokens.vocabulary(BYTE)).count() == 0


# --- quality ----------------------------------------------------------------


def base(text):
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_quality_counts(docs, empty):
    path = tokens.vocabulary(PIECES)
    for row in quality.judged(docs, path).collect():
        counts, q = base(row["text"] or ""), row["quality"]
        assert counts == (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words)
        assert q.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (q.base_failed and q.kept)
    assert quality.judged(empty, path).count() == 0


def test_fertility_rejects_symbol_noise_and_keeps_prose():
    use = quality.pieces(tokens.vocabulary(PIECES))
    noise = " ".join(f"w{i}{'***%%%&&&$$$'[3 * (i % 4):][:3]}" for i in range(400))
    assert not quality.judge(noise, "en", use, quality.BANDS)[-1]
    assert quality.judge(PASSAGE, "en", use, quality.BANDS)[-1]
    assert use.measure(["ab", "cd"] * 3)[0] == sum(map(len, use.model.encode(["ab", "cd"]))) * 3


@pytest.mark.parametrize("lang", [None, "", "EN", "it", "latin"])
def test_fertility_without_a_known_language(lang):
    use = quality.pieces(tokens.vocabulary(PIECES))
    pick = np.random.default_rng(3)
    parts = ["zu", "ka", "xo", "vi", "ne", "qa", "by"]
    invented = " ".join("".join(pick.choice(parts, 3)) for _ in range(400))
    symbols = " ".join("".join(pick.choice([*parts, "#", "%", "*"], 4)) for _ in range(400))
    before = {k: v for k, v in quality.BANDS.items() if k != quality.LATIN}
    assert quality.judge(invented, lang, use, before)[-1]  # the wide band does not see it
    assert not quality.judge(symbols, lang, use, quality.BANDS)[-1]
    assert not quality.judge(invented, lang, use, quality.BANDS)[-1]
    assert quality.judge(PASSAGE, lang, use, quality.BANDS)[-1]
    russian = " ".join("".join(pick.choice(list("абвгдежзиклмнопрстуф"), 6)) for _ in range(200))
    assert quality.judge(russian, lang, use, quality.BANDS)[-1]  # another script


# --- line dedup -------------------------------------------------------------


def runs_removed(rows, least=50):
    """Deletes each line that lies in a run of enough words found at an earlier place."""
    texts = sorted({((1 << 63) - 1 if d is None else d, t) for d, t, *_ in rows if t is not None})
    split = [t.split("\n") for _, t in texts]
    gone = [set() for _ in texts]
    first = {}
    for k, ls in enumerate(split):
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                if sum(len(WORD.findall(x)) for x in ls[a:b]) >= least:
                    run = tuple(ls[a:b])
                    if run in first and first[run] != (k, a):
                        gone[k].update(range(a, b))
                    first.setdefault(run, (k, a))
    return {(d if d < (1 << 63) - 1 else None, t): "\n".join(x for i, x in enumerate(ls) if i not in g) for (d, t), ls, g in zip(texts, split, gone)}


def test_line_dedup(docs, empty):
    want = runs_removed(ROWS)
    plain = docs.withColumnRenamed("text", "body").withColumn("text", F.lit("clash"))
    found = lines.deduplicated(docs.withColumn("before", F.col("text")).withColumn("line_dedup", F.lit(1))).collect()
    assert len(found) == len(ROWS)
    for row in found:
        assert row["text"] == (None if row["before"] is None else want[(row["doc_id"], row["before"])])
    assert lines.deduplicated(plain, text="body").where("text = 'clash'").count() == len(ROWS)
    assert lines.deduplicated(empty).count() == 0


def test_line_dedup_of_longer_runs(spark):
    pick = np.random.default_rng(2)
    pool = [" ".join(f"x{i}_{j}" for j in range(int(pick.integers(0, 30)))) for i in range(12)]
    rows = []
    for doc in range(40):
        body = [pool[i] for i in pick.integers(0, 12, int(pick.integers(1, 15)))]
        if doc % 3:
            body[1:1] = [pool[i] for i in (3, 4, 5, 6, 7)] + [f"unique {doc}"]
        rows.append((doc, "\n".join(body)))
    want = runs_removed(rows)
    for row in lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").withColumn("before", F.col("text"))).collect():
        assert row["text"] == want[(row["doc_id"], row["before"])], row["doc_id"]


# --- SimHash ----------------------------------------------------------------


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    label = list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_in_small_parts(docs, monkeypatch):
    monkeypatch.setattr(simhash, "PART_BYTES", 64)
    monkeypatch.setattr(simhash, "PART_SHINGLES", 7)
    for _, text, *_ in ROWS:
        assert simhash.fingerprint(text) & (2**64 - 1) == fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 6])
def test_bit_planes_find_every_link(radius, monkeypatch):
    monkeypatch.setattr(simhash, "BATCH", 100)
    pick = np.random.default_rng(radius)
    centres = pick.integers(0, 2**63, 6, dtype=np.uint64)
    for spread in (1, 3, 60):
        values = centres[pick.integers(0, 6, 400)]
        for _ in range(radius + 1):
            values = values ^ (np.uint64(1) << pick.integers(0, 64, 400).astype(np.uint64))
        keys = np.sort(pick.integers(0, spread, 400))
        want = groups(list(zip(keys, values)), lambda a, b: a[0] == b[0] and (int(a[1]) ^ int(b[1])).bit_count() <= radius)
        assert simhash.linked(keys, values, np.zeros(400, int), radius).tolist() == want


@pytest.mark.parametrize("options", [{}, {"cut": 5}, {"parts": 6}, {"parts": 5, "cut": 3}])
def test_components_of_fingerprints(spark, options):
    pick = np.random.default_rng(9)
    centres = pick.integers(0, 2**62, 10, dtype=np.int64)
    values = np.unique(np.concatenate([centres ^ (1 << pick.integers(0, 62, 10)) ^ (1 << pick.integers(0, 62, 10)) for _ in range(12)]))
    want = groups(values.tolist(), lambda a, b: (a ^ b).bit_count() <= 3)
    found = dict(map(tuple, common.components(simhash.links(spark.createDataFrame([(int(v),) for v in values], "fp long"), **options)).collect()))
    assert [found.get(v, v) for v in values.tolist()] == [int(values[i]) for i in want]


def test_simhash_classes(docs, empty):
    fps = [fingerprint(t) for _, t, *_ in ROWS]
    label = groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {g: min((d for (d, *_), x in zip(ROWS, label) if x == g and d is not None), default=None) for g in label}
    assert bag(r[:1] + (r[1] & (2**64 - 1), r[2]) for r in simhash.classes(docs).collect()) == bag((d, f, least[g]) for (d, *_), f, g in zip(ROWS, fps, label))
    kept = simhash.representatives(docs.withColumn("fp", F.lit("clash")))
    assert kept.columns[-1] == "fp" and kept.count() == len(set(label))
    assert simhash.classes(empty).count() == simhash.representatives(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    found = dict(map(tuple, common.components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(201)) and all(found[i] == 1000 for i in range(1000, 1400))


# --- mixing -----------------------------------------------------------------


def shared(sizes, weights, share=1.5, most=2):
    """Shares the budget by weight, caps, and shares the excess again until none is above."""
    target = {s: 0.0 for s in sizes}
    open_, rest = set(sizes), share * sum(sizes.values())
    while open_ and rest > 1e-9:
        whole = sum(weights[s] for s in open_)
        given = {s: target[s] + rest * weights[s] / whole for s in open_}
        rest = sum(max(0, g - most * sizes[s]) for s, g in given.items())
        target.update({s: min(g, most * sizes[s]) for s, g in given.items()})
        open_ = {s for s in open_ if target[s] < most * sizes[s]}
    return target


def test_mixing(spark, docs, empty):
    many = docs.unionByName(spark.range(300).select((F.col("id") + 100).alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 17 as int))").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 5).alias("source")))
    rows = mixing.planned(many).collect()
    sizes = collections.Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = shared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert np.floor(rate) <= r["copies"] <= np.ceil(rate)
    clash = many.withColumn("size", F.lit("x"))
    assert mixing.mixed(clash).columns == clash.columns
    assert mixing.mixed(many).count() == sum(r["copies"] for r in rows)
    assert mixing.planned(empty).count() == mixing.mixed(empty).count() == 0


# --- packing ----------------------------------------------------------------


def checked(rows, ids_of, capacity):
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = ids_of[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
    for spans in by_sequence.values():
        end = 0
        for start, length in sorted(spans):
            assert start == end
            end += length
        assert end <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence, by_doc


def test_packing(docs, empty):
    lib = library(WORDS)
    ids_of = {d: lib.encode(t or "", add_special_tokens=False).ids + [2] for d, t, *_ in ROWS}
    for capacity, step in ((4096, 8), (512, 8), (100, 7)):
        rows = packing.packed(docs, tokens.vocabulary(WORDS), capacity=capacity, step=step).collect()
        _, by_doc = checked(rows, ids_of, capacity)
        for (doc_id, spans), copies in ((x, 2 if x[0] == 6 else 1) for x in by_doc.items()):
            assert sum(n for _, n in spans) == copies * len(ids_of[doc_id])
    assert packing.packed(empty, tokens.vocabulary(WORDS)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_patterns_cover_the_histogram(n):
    pick = np.random.default_rng(n)
    lengths = np.minimum(1024, np.exp(pick.normal(5, 1.2, n)).astype(int) + 1)
    demand = np.bincount(-(-lengths // 8), minlength=129)[1:]
    plan = packing.plan(demand)
    covered = np.zeros(128, int)
    for pattern, times in plan:
        assert sum(a * b for a, b in pattern.items()) <= 128
        for size, each in pattern.items():
            covered[size - 1] += each * times
    assert (covered == demand).all()
    used, ideal = sum(t for _, t in plan), lengths.sum() / 1024
    assert used <= 1.02 * ideal + 2


def test_prices_are_the_best_knapsack():
    pick = np.random.default_rng(0)
    for _ in range(20):
        worth = pick.uniform(-0.1, 1, 9) * np.arange(1, 10)
        best = {0: 0.0}
        for c in range(1, 10):
            best[c] = max([best[c - 1]] + [best[c - j - 1] + worth[j] for j in range(c)])
        value, pattern = packing.price(worth, 9)
        assert value == pytest.approx(best[9]) and (pattern * np.arange(1, 10)).sum() <= 9
        assert value == pytest.approx((pattern * worth).sum())


# --- token files ------------------------------------------------------------


def test_token_files_round_trip(spark, docs, empty):
    lib = library(BYTE)
    folder = run_dir(spark, "files")
    binary.write_ids(docs, tokens.vocabulary(BYTE), folder)
    found = sorted(binary.read_ids(spark, folder, keep_ids=True).collect(), key=lambda r: r["start"])
    before = 0
    for row in found:
        ids = np.frombuffer(row["ids"], "<u4")
        assert row["start"] == before and row["n_tokens"] == len(ids) and row["ids_crc32"] == zlib.crc32(row["ids"])
        before += len(ids)
    assert [r["doc_id"] for r in found] == sorted((d for d, *_ in ROWS), key=lambda d: (d is not None, d))
    want = collections.Counter((d, tuple(lib.encode(t or "", add_special_tokens=False).ids + [2])) for d, t, *_ in ROWS)
    assert collections.Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found) == want
    assert binary.lookup(spark, folder, 1).tolist() == lib.encode(ROWS[0][1]).ids + [2]
    assert binary.lookup(spark, folder, 77) is None
    nothing = run_dir(spark, "files")
    binary.write_ids(empty, tokens.vocabulary(BYTE), nothing)
    assert binary.read_ids(spark, nothing).count() == 0


def test_blocks_refuse_another_dictionary():
    tool = binary.compressor(b"")
    made = binary.block([tool.compress(b"\x01\x00\x02\x00")], 2, binary.dictionary_hash(b""))
    assert binary.read_frame(made, 0, b"").tolist() == [1, 2]
    with pytest.raises(ValueError, match="another dictionary"):
        binary.open_block(made, binary.dictionary_hash(b"x"))
    with pytest.raises(ValueError, match="format"):
        binary.open_block(b"XXXX" + made[4:], binary.dictionary_hash(b""))


# --- toxicity ---------------------------------------------------------------


def test_toxicity_learns_pairs_and_handles_nulls(spark, docs, empty):
    """Two words that are harmless alone and toxic together: no additive weight can tell."""
    rows = []
    for i in range(1200):
        a, b = i % 2, i // 2 % 2
        filler = " ".join(f"f{(i * 7 + j) % 40}" for j in range(8))
        rows.append((i, f"{filler} {'grumple' if a else ''} {'zorbians' if b else ''}", float(a and b)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label double")
    model = toxicity.fit(labelled)
    scored = model.scores(labelled.withColumn("terms", F.lit("clash")).drop("terms")).select("label", "score").collect()
    assert all((s >= 0.5) == (x == 1) for x, s in scored)
    assert all(0 <= r["score"] <= 1 for r in model.scores(docs).collect())
    assert model.scores(empty).count() == 0
    plain = toxicity.fit(labelled.where("label = 0"))
    assert plain.machine is None and plain.scores(docs).where("score != 0").count() == 0
    assert toxicity.fit(labelled.limit(0)).scores(docs).count() == len(ROWS)


# --- embeddings -------------------------------------------------------------


def test_embedding_links(spark):
    pick = np.random.default_rng(1)
    centres = pick.normal(size=(12, 5))
    rows = [(i, [float(np.float32(v)) for v in centres[i % 12] + (pick.normal(size=5) * 0.15 if i % 3 else 0)]) for i in range(300)]
    rows += [(700, None), (701, [0.0] * 5), (702, [float("nan")] * 5), (703, [1.0, None, 0.0, 0.0, 0.0]), (704, [1.0, 2.0]), (705, []), (706, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("clash"))
    sound = [i for i, (_, v) in enumerate(rows) if v and len(v) == 5 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = np.array([rows[i][1] for i in sound], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = groups(list(range(len(sound))), lambda a, b: near[a, b])
    least = {g: min(rows[sound[i]][0] for i in range(len(sound)) if label[i] == g) for g in label}
    want = {i: (rows[i][0], 0, rows[i][0], True) for i in range(len(rows))}
    want |= {i: (rows[i][0], int(near[k].sum()), least[label[k]], rows[i][0] == least[label[k]]) for k, i in enumerate(sound)}
    for interval in (40, 4096):
        assert bag(embeddings.linked(frame, interval=interval).collect()) == bag(want.values())
    assert embeddings.linked(frame.limit(0)).count() == 0
    assert embeddings.linked(frame.where("vec_id BETWEEN 700 AND 703")).count() == 4


def test_embeddings_of_every_length_and_magnitude(spark):
    """Links within each length; norms that would under- or overflow count."""
    vectors = {
        1: [1.0, 0.0, 0.0], 2: [2.0, 0.1, 0.0], 3: [0.0, 0.0, 1.0], 4: [1.0, 0.0], 5: [3.0, 0.0], 6: [0.0, 1.0],
        7: [1e-200, 0.0, 0.0, 0.0], 8: [1e-200, 1e-202, 0.0, 0.0], 9: [0.0, 0.0, 1e200, 0.0], 10: [0.0, 0.0, 1e200, 1.0], 11: [5e-324, 0.0, 0.0, 0.0], 12: [2.0], 13: [-2.0],
    }
    rows = [(k, v) for k, v in vectors.items()] + [(20 + i, [float(i + 1), 1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    flat = [(k, np.array(v) / max(map(abs, v))) for k, v in rows]
    near = {k: {j for j, w in flat if j != k and len(w) == len(v) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.9} for k, v in flat}
    for interval in (2, 4096):
        got = {r["vec_id"]: r for r in embeddings.linked(frame, interval=interval).collect()}
        assert {k: r["n_links"] for k, r in got.items()} == {k: len(v) for k, v in near.items()}
        assert [got[k]["component_id"] for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13)] == [1, 1, 3, 4, 4, 6, 7, 7, 9, 9, 7, 12, 13]


def test_short_pieces_fill_their_sequences(spark):
    """Texts of one to forty tokens: hardly any padding, and every sequence within its capacity."""
    pick = np.random.default_rng(4)
    rows = [(i, None) for i in range(9000)] + [(10_000 + i, "the " * int(n)) for i, n in enumerate(pick.integers(1, 40, 3000))]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tokens.vocabulary("word_bpe_49k.json")).toPandas()
    assert sorted(got.doc_id) == sorted(k for k, _ in rows)
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 4096 and len(fill) == -(-int(got.length.sum()) // 4096)
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.offset == placed.groupby("sequence_id").length.cumsum() - placed.length).all()


def test_bundles_hold_every_short_piece():
    counts = {-1: 2050, -7: 300, -256: 9, 40: 5, 128: 3}
    items, where = packing.bundles(counts, 4096, 8)
    held = {s: sum(h * (n // h if first == 0 and h == max(1, 1024 // -s) else 1) for first, h, _, _ in w for n in [counts[s]]) for s, w in where.items()}
    assert held == {s: n for s, n in counts.items() if s < 0}
    assert items[39] == 5 and items.sum() == 5 + 3 + 3 + 3 + 3


# --- packing's program beside a live session ---------------------------------


def test_the_program_runs_beside_a_session(spark):
    """Over 100 steps after the session has forked: no threaded library may be called."""
    assert spark.range(3).count() == 3
    pick = np.random.default_rng(3)
    demand = np.bincount(np.minimum(np.ceil(pick.exponential(60, 20_000)).astype(int), 512), minlength=513)[1:]
    basis, amount = packing.solve(demand)
    assert (np.einsum("ij,i->j", basis.astype(float), amount) >= demand - 1).all()
    done = collections.Counter()
    for pattern, times in packing.plan(demand):
        assert sum(size * n for size, n in pattern.items()) <= 512
        for size, n in pattern.items():
            done[size] += n * times
    assert all(done[i + 1] == n for i, n in enumerate(demand))
    square = pick.normal(size=(160, 160))
    np.testing.assert_allclose(np.einsum("ij,jk->ik", square, packing.inverted(square)), np.eye(160), atol=1e-8)
    with pytest.raises(ValueError, match="singular"):
        packing.inverted(np.zeros((2, 2)))

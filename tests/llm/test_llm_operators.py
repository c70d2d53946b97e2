"""Each operator against a plain version, on odd rows, on empty tables and on the small tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filingflow.llm import (
    chunks, idfiles, jaccard, language_model, licenses, mixing, neighbours, packing, quality, repeats, simple8b, tokens, toxicity,
)
from filingflow.llm.queries import QUERIES
from filingflow.llm.words import Words


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- quality rules --------------------------------------------------------------


def check_measures(scored, source):
    want = Counter((d, *plain.quality_measures(t).values()) for d, t in source)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(scored.select("doc_id", *names)) == want


def test_quality_measures(docs, odd, labels):
    check_measures(quality.quality(docs, labels), pairs(docs))
    scored = quality.quality(odd, labels)
    check_measures(scored, pairs(odd))
    assert scored.filter("kept AND base_failed").isEmpty()
    assert set(odd.columns) - {"N_Words", "kept"} <= set(scored.columns)


def test_quality_score_is_the_mean_log_ratio(spark, docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality")).filter("doc_id % 2 = 0")
    buckets, prior = 64, 100.0
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels, buckets, prior).collect()}
    hashed = {
        r["doc_id"]: r["h"] + r["p"]
        for r in spark.createDataFrame([(d, plain.words(t)) for d, t in pairs(docs)], "doc_id long, w array<string>").selectExpr(
            "doc_id", f"transform(w, x -> xxhash64(x) & {buckets - 1}) h",
            f"transform(sequence(1, greatest(size(w) - 1, 1)), i -> xxhash64(xxhash64(w[i - 1]), xxhash64(get(w, i))) & {buckets - 1}) p",
        ).collect()
    }
    raw = Counter(b for own in hashed.values() for b in own)
    good = Counter(b for d, own in hashed.items() if d % 2 == 0 for b in own)
    n, m = sum(raw.values()), sum(good.values())
    for d, own in hashed.items():
        ratio = [np.log((good[b] + prior * raw[b] / n) / (m + prior) / (raw[b] / n)) for b in own]
        if len(own) > 1:
            assert got[d] == pytest.approx(np.mean(ratio), abs=1e-9)


def test_quality_separates_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    train = labels.filter("doc_id % 2 = 0")
    held = quality.quality(docs, train).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed")
    good = held.filter("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = held.filter("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.9 and bad < 0.3


def test_quality_of_nothing(empty, labels):
    assert quality.quality(empty, labels).count() == 0
    assert quality.quality(empty, labels.limit(0)).count() == 0


# --- licenses --------------------------------------------------------------------


def held_licenses(text):
    own = Words_plain(text)
    found = {}
    for name, template in licenses.TEMPLATES.items():
        want = set(zip(*(Words_plain(template)[i:] for i in range(3))))
        have = list(zip(*(own[i:] for i in range(3))))
        width = len(Words_plain(template))
        best = max((len(want & set(have[i : i + width])) / len(want) for i in range(len(have))), default=0)
        if best >= 0.75:
            found[name] = best
    return found


def Words_plain(text):
    for c in ".,;:()\"'":
        text = (text or "").replace(c, " ")
    return plain.words(plain.fold(text))


def test_licenses_are_found_where_they_are(spark, docs, odd):
    for table in (docs, odd, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        got = defaultdict(dict)
        for r in licenses.licenses(table).collect():
            got[r["doc_id"]][r["license"]] = r["containment"]
        want = defaultdict(dict)
        for d, t in pairs(table):
            want[d] |= held_licenses(t)
        assert {d: set(v) for d, v in got.items()} == {d: set(v) for d, v in want.items() if v}


@pytest.mark.parametrize("lead", range(0, 23))
def test_a_license_is_found_wherever_it_starts(spark, lead):
    texts = [" ".join(f"p{i}" for i in range(lead)) + " " + t + " tail words go on" for t in licenses.TEMPLATES.values()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = licenses.licenses(df).filter("containment = 1").select("doc_id", "license", "first_word").collect()
    assert {(r["doc_id"], r["license"]) for r in got} >= set(enumerate(licenses.TEMPLATES))


def test_each_text_of_an_id_is_verified(spark):
    whole = licenses.TEMPLATES["bsd-3-clause"]
    half = " ".join(whole.split()[:8] + [f"other{i}" for i in range(20)])
    rows_in = [(1, whole), (1, half), (2, half), (2, whole), (3, half), (4, whole), (4, whole), (None, half), (None, whole), (None, half + " x")]
    df = spark.createDataFrame(rows_in, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["license"], r["containment"], r["n_windows"]) for r in licenses.licenses(df).collect()}
    assert set(got) == {1, 2, 4, None} and set(got.values()) == {("bsd-3-clause", 1.0, got[4][2])}


def test_licenses_of_nothing(spark, empty):
    assert licenses.licenses(empty).count() == 0
    with pytest.raises(Exception, match="too short"):
        licenses.licenses(empty, {"x": "two words"}).collect()
    with pytest.raises(ValueError):
        licenses.licenses(empty, {f"t{i}": "a b c d" for i in range(10_001)})


# --- mixing ----------------------------------------------------------------------


def poisson(mean, u):
    p = c = np.exp(-mean)
    k = 0
    while c <= u and k < 500:
        k += 1
        p *= mean / k
        c += p
    return k


def test_mixing_inverts_the_poisson_distribution(spark, odd):
    weights = spark.createDataFrame([("src0", 5.0), ("src1", 1.0), (None, 40.0)], "source string, weight double")
    got = mixing.mix(odd, weights, rows_out=400.0)
    assert got.columns[: len(odd.columns)] == odd.columns
    counts = Counter(r["doc_id"] for r in got.collect())
    sizes = Counter(r["source"] for r in odd.collect())
    want = Counter()
    for r in odd.collect():
        rate = {"src0": 5.0, "src1": 1.0, None: 40.0}.get(r["source"], 0.0) / 46 * 400 / sizes[r["source"]]
        parts = max(1, int(np.ceil(rate / 16)))
        name = "null" if r["doc_id"] is None else str(r["doc_id"])
        for part in range(1, parts + 1):
            u = int(hashlib.md5(f"17:{name}:{part}".encode()).hexdigest()[:13], 16) / 2**52
            want[r["doc_id"]] += poisson(rate / parts, u)
    assert counts == +want
    keys = [r["shuffle_key"] for r in got.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_mixing_meets_target_shares(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 20)) source")
    mixed = mixing.mix(docs)
    sizes = dict(docs.groupBy("source").count().collect())
    total = sum(n**0.5 for n in sizes.values())
    for source, n in mixed.groupBy("source").count().collect():
        target = sizes[source] ** 0.5 / total * 20_000
        assert abs(n - target) < 5 * target**0.5


def test_mixing_of_nothing(empty):
    assert mixing.mix(empty).count() == 0


# --- packing ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_packing(placed, source, tokenizer, size):
    want = Counter()
    for d, t in source:
        ids = plain.encoded(tokenizer, t, 0)
        for piece, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want[d, piece, at, len(part), plain.crc(part)] += 1
    found = placed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    total = sum(n for held in bins.values() for _, n in held)
    return len(bins), -(-total // size)


def test_packing(docs, odd, word_bpe):
    used, least = check_packing(packing.pack(docs), pairs(docs), word_bpe, 2048)
    assert used <= least * 1.03 + 1
    check_packing(packing.pack(odd, size=64), pairs(odd), word_bpe, 64)


def test_plan_uses_exact_complements():
    counts = np.zeros(101, np.int64)
    for n, c in {60: 3, 40: 3, 50: 4, 70: 2, 20: 2, 10: 2, 90: 1, 5: 1, 3: 1, 2: 1}.items():
        counts[n] = c
    patterns = packing.plan(counts, 100)
    assert all(sum(p) == 100 for p, _ in patterns) and sum(t for _, t in patterns) == 3 + 2 + 2 + 1


def test_plan_places_every_piece():
    rng = np.random.default_rng(3)
    for size in (16, 100, 512):
        counts = np.append(0, rng.integers(0, 9, size) * (rng.random(size) < 0.4))
        patterns = packing.plan(counts, size)
        used = Counter()
        for lengths, times in patterns:
            assert sum(lengths) <= size and times > 0
            for n in lengths:
                used[n] += times
        assert used == Counter({n: int(c) for n, c in enumerate(counts) if c})
        total = int((counts * np.arange(size + 1)).sum())
        assert sum(t for _, t in patterns) <= -(-total // size) * 1.25 + 1


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


# --- tokenizers and id files --------------------------------------------------------


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoding_equals_the_tokenizer(docs, odd, name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.public_path(name))
    tokenizer.encode_special_tokens = True
    own = tokens.Encoder(tokens.public_path(name), remembered=500)
    for _, text in pairs(docs) + pairs(odd):
        got = np.frombuffer(own.encode(text or ""), "<u2").tolist()
        assert got == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_many_texts_at_a_time_encode_as_one_by_one(docs, odd):
    """Distinct parts and pieces go through the merge table once, and every id is the tokenizer's."""
    from tokenizers import Tokenizer

    path = tokens.public_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = np.random.default_rng(3)
    bits = [
        "a", "B", "é", "'", "'s", "don't", "12", " ", "  ", "\n", "\n\n", "\t", " \n", "\x1c", "\x85", "\xa0", "ÿ", "²", "½",
        "Ā", "中", "ǅ", "🙂", ".", "..!", "<|endoftext|>", "×", "the", "\x00", "ª", "'re", "\u2003", "\u3000",
    ]
    made = ["".join(rng.choice(bits, rng.integers(0, 25))) for _ in range(1500)]
    texts = [t for _, t in pairs(docs) + pairs(odd)] + made
    own = tokens.Encoder(path, remembered=500)
    for some in (texts[:1], texts, [None, "", None], [" "], ["word"]):
        lengths, ids = own.encode_all(pa.array(some, pa.string()))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert own.encode_all(pa.array([], pa.string()))[1].tolist() == []

    calls, tokenize = [], own.tokenize
    own.tokenize = lambda letters: calls.append(letters) or tokenize(letters)
    own.encode_all(pa.array(["x y"] + ["x " + " ".join(f"q{i % 100}z" for i in range(5000))] * 20))
    assert len(calls) <= 1 + -(-201 // tokens.MERGED_TOGETHER)  # by single pieces: 201 calls


def test_simple8b_round_trip():
    rng = np.random.default_rng(5)
    for bits in (0, 1, 7, 15, 16, 33, 60, 63, 64):
        for n in (0, 1, 255, 256, 257, 3000):
            values = rng.integers(0, 2**64, n, dtype=np.uint64) >> np.uint64(64 - bits) if bits else np.zeros(n, np.uint64)
            values[rng.random(n) < 0.5] &= np.uint64(3)
            words, blocks = simple8b.encode(values)
            assert (simple8b.decode(words, blocks, n) == values).all()
    small = rng.integers(0, 2, 2560).astype(np.uint64)
    assert len(simple8b.encode(small)[0]) == 10 * 5


def check_ids(got, source, tokenizer):
    found = got.collect()
    wanted = [(d, plain.encoded(tokenizer, t, 2)) for d, t in source]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter(
        (d, len(ids), plain.crc(ids)) for d, ids in wanted
    )
    order = sorted(found, key=lambda r: r["start"])
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert keys == sorted(keys)
    at = 0
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]


def test_id_files(docs, odd, byte_bpe, folder, monkeypatch):
    check_ids(idfiles.round_trip(docs), pairs(docs), byte_bpe)
    monkeypatch.setattr(idfiles, "SEGMENT", 1000)
    idfiles.write_ids(odd, f"{folder}/ids", ranges=4)
    check_ids(idfiles.read_digests(odd.sparkSession, f"{folder}/ids"), pairs(odd), byte_bpe)


def test_id_files_of_nothing(empty):
    assert idfiles.round_trip(empty).count() == 0


# --- substring dedup ----------------------------------------------------------------


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 3000])
def test_repeats(docs, odd, chunk_bytes, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 20_000)
    for table in (docs, odd):
        got = repeats.remove_repeats(table, ["doc_id"])
        assert rows(got) == Counter(plain.removed_words(pairs(table)))


def test_repeats_keep_columns(odd):
    got = repeats.remove_repeats(odd)
    assert set(got.columns) == {"doc_id", "text", "source", "lang", "kept", "n_words", "n_removed", "kept_sha256"}
    untouched = got.filter("n_removed = 0").select("doc_id", "text")
    assert rows(untouched) <= rows(odd.select("doc_id", "text"))
    for r in got.filter("n_removed > 0").collect():
        assert hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"]


def test_repeats_of_nothing(empty):
    assert repeats.remove_repeats(empty).count() == 0


# --- Jaccard join -------------------------------------------------------------------


def test_jaccard_components(spark, docs):
    for table in (docs, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        got = jaccard.jaccard_components(table).select("doc_id", "n_shingles", "component_id")
        assert rows(got) == Counter(plain.jaccard_groups(pairs(table)))


def near_copies(n, changed):
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.choice(150, changed, replace=False):
            own[at] = f"x{i}-{at}"
        out.append((i + 1, " ".join(own)))
    return out


@pytest.mark.parametrize("changed", [1, 2, 3, 4])
def test_jaccard_links_near_copies_without_a_common_base(spark, changed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SALT_ROWS", 10)
    source = near_copies(60, changed) + [(100, "unlike words " * 9), (101, None), (102, "a b"), (103, "a b"), (104, "A B c")]
    df = spark.createDataFrame(source, "doc_id long, text string")
    got = jaccard.jaccard_components(df).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == Counter(plain.jaccard_groups(source))


def test_jaccard_groups_of_two_end_with_their_hub(spark, monkeypatch):
    rng = np.random.default_rng(2)
    source = []
    for i in range(20):  # pairs that share bands and are not similar
        base = [f"p{i}-{j}" for j in range(100)]
        for _ in range(2):
            own = list(base)
            for at in rng.choice(100, 5, replace=False):
                own[at] = f"x{rng.integers(1 << 40)}"
            source.append((len(source), " ".join(own)))
    left, blocked = [], jaccard._blocked
    monkeypatch.setattr(jaccard, "_blocked", lambda members: left.append(members.count()) or blocked(members))
    got = jaccard.jaccard_components(spark.createDataFrame(source, "doc_id long, text string"))
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == Counter(plain.jaccard_groups(source))
    assert left == [0]


@pytest.mark.parametrize("order", [1, -1])
def test_jaccard_compares_with_every_set_of_a_hub(order):
    near, other, empty = (np.arange(i, i + 40, dtype=np.uint64) for i in (0, 1000, 0))
    packed = [chunks.squeeze_sorted(s) for s in (near, other, empty[:0])][::order]
    hubs = pa.table({"b": [1] * 3, "salt": [0] * 3, "hub_keys": packed})
    own = [chunks.squeeze_sorted(s) for s in (near[2:], other[1:], near + np.uint64(30), empty[:0])]
    pairs = pa.table({"a": [2, 3, 4, 5], "b": [1] * 4, "salt": [0] * 4, "keys": own})
    assert jaccard._similar(pairs, hubs).to_pydict() == {"a": [2, 3], "b": [1, 1]}


def test_jaccard_on_odd_rows(odd):
    found = jaccard.jaccard_components(odd).collect()
    assert len(found) == odd.count()
    groups = {r["doc_id"]: r["component_id"] for r in found if r["n_shingles"] > 100}
    assert groups[17] == groups[18] == groups[19] == groups[20] == groups[21] == 3
    assert all(r["component_id"] == r["doc_id"] for r in found if r["n_shingles"] == 0 or r["doc_id"] is None)


def test_jaccard_of_nothing(empty):
    assert jaccard.jaccard_components(empty).count() == 0


def test_components_of_a_chain(spark):
    from filingflow.llm.components import components

    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (105, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 105: 100}


# --- neighbours ---------------------------------------------------------------------


def test_nearest_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = QUERIES["op6_adaptive_scan"](spark, sf_dir).collect()
    want = plain.nearest([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    exact = {(q, v): d for q, _, v, d in want}
    assert len(got) == len(want)
    assert sum((r["query_id"], r["vec_id"]) in exact for r in got) >= 0.9 * len(want)
    for r in got:
        if (r["query_id"], r["vec_id"]) in exact:
            assert r["score"] == pytest.approx(exact[r["query_id"], r["vec_id"]], abs=1e-12)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows_in = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
               (7, [2.0, 0.0]), (8, [0.0, 0.0, 1.0]), (100, [1.0, 0.0]), (None, [1.0, 1.0]), (9, []), (7, [2.0, 0.0])]
    df = spark.createDataFrame(rows_in, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect()
    want = plain.nearest([r for r in rows_in if r[0] not in (8, 9)])
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_hot_vector_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 50)
    monkeypatch.setattr(neighbours, "QUERY_PART", 2)
    rng = np.random.default_rng(2)
    rows_in = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).round(3).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows_in, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0, probed=1.0).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((q, r, v) for q, r, v, _ in plain.nearest(rows_in))


@pytest.mark.parametrize("dim, length", [(32, 1.0), (64, 1.0), (64, 1e8), (128, 1e-8)])
def test_scan_keeps_all_copies_of_the_query(dim, length):
    turn = neighbours.rotation(dim)
    for seed in range(8):
        rng = np.random.default_rng(seed)
        own = rng.standard_normal((2000, dim))
        hot = np.concatenate([np.arange(30), rng.choice(np.arange(30, 2000), 100, replace=False)])
        own[hot] = own[0]
        own *= length
        rotated = np.ascontiguousarray((own @ turn).T)
        for query in own[np.arange(3)] @ turn:
            assert set(hot) <= set(neighbours.scan(query, rotated, 10).tolist())


# --- toxicity -----------------------------------------------------------------------


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = toxicity.grade(docs, model).join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").toPandas()
    assert (held["toxic"] == (held["label"] == 1)).mean() > 0.97
    assert held.loc[held["label"] == 1, "severity"].mean() > 1 > 0.2 > held.loc[held["label"] == 0, "severity"].mean()


def test_toxicity_of_odd_rows(odd, empty, labels):
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    assert toxicity.toxicity(odd, labels.limit(0)).filter("toxic OR grade > 0").isEmpty()
    assert toxicity.toxicity(empty, labels).count() == 0


def test_ordinal_fit_shares_weights():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 2))
    grades = np.clip(np.digitize(2 * x[:, 0] + rng.logistic(size=4000), [-1, 1, 3]), 0, 3)
    weights, thresholds = toxicity.fit(x, grades)
    assert weights == pytest.approx([2, 0], abs=0.25) and thresholds == pytest.approx([-1, 1, 3], abs=0.35)


# --- language model -----------------------------------------------------------------


def check_base(got, source):
    found = {}
    for r in got.collect():
        found.setdefault((r["doc_id"], r["n_tokens"]), []).append(r)
    want = plain.base_scores(source)
    assert sum(map(len, found.values())) == len(want)
    for d, held, n, known, total, base in want:
        r = found[d, n][0]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_language_model_scores(spark, docs, odd, empty):
    got = language_model.score(docs)
    check_base(got, pairs(docs))
    assert language_model.score(odd).count() == odd.count()
    assert language_model.score(empty).count() == 0


def small_model():
    rng = np.random.default_rng(6)
    model = language_model.Model(rng.poisson(0.01, language_model.IDS * language_model.KINDS).astype(float))
    model.set_prior(rng.integers(0, 50, language_model.CLASSES**2).astype(float))
    model.weights = rng.standard_normal(len(model.weights)) * 0.2
    return model


def sequence(n, seed=0):
    ids = np.random.default_rng(seed).integers(0, 50_000, n).astype("<u2")
    return language_model.Sequences(
        {"lengths": chunks.squeeze(np.array([n], "<u4")), "training": np.packbits([True]).tobytes(), "ids": chunks.squeeze(ids)}
    )


def test_each_id_is_scored_once_and_probabilities_sum_to_one():
    model = small_model()
    for n in (0, 1, 23, 24, 25, 100):
        own = sequence(n) if n else language_model.Sequences(
            {"lengths": chunks.squeeze(np.array([0], "<u4")), "training": b"\x80", "ids": chunks.squeeze(np.zeros(0, "<u2"))}
        )
        doc, at = own.windows()
        inputs, targets, counts, within = own.batch(doc, at)
        assert counts.sum() == n + 1
        assert targets[counts].tolist() == own.ids[1:].tolist()
    f = model.forward(model.parts(model.weights), inputs, within)
    p = f["p"] / f["sum"][:, None]
    inside = np.exp(model.inside.astype(float))
    every = p[:, model.classes] * inside
    assert every.sum(1) == pytest.approx(np.ones(len(p)), abs=1e-4)


def test_the_model_is_causal():
    model = small_model()
    w = model.parts(model.weights)
    own = sequence(24)
    doc, at = own.windows()
    batch = own.batch(doc[:1], at[:1])
    one = model.forward(w, batch[0], batch[3])["p"]
    changed = batch[0].copy()
    changed[:, -1] = 5
    two = model.forward(w, changed, batch[3])["p"]
    assert np.allclose(one[:-1], two[:-1]) and not np.allclose(one[-1], two[-1])


def test_every_training_window_is_used_once():
    lengths = np.array([70_000, 0, 5, 24, 1000, 300, 48, 2000], "<u4")
    ids = np.random.default_rng(1).integers(0, 50_000, int(lengths.sum())).astype("<u2")
    training = np.array([1, 1, 1, 0, 1, 1, 1, 0], bool)
    own = language_model.Sequences(
        {"lengths": chunks.squeeze(lengths), "training": np.packbits(training).tobytes(), "ids": chunks.squeeze(ids)}
    )
    want = Counter((d, a) for d, a in zip(*(x.tolist() for x in own.windows()), strict=True) if training[d])
    for chunk in (0, 5 << 24 | 3):
        got, n = Counter(), []
        for turn in range(language_model.ROUNDS):
            doc, at = language_model._drawn(own, chunk, turn)
            got.update(zip(doc.tolist(), at.tolist(), strict=True))
            n.append(int((doc == 0).sum()))
        assert got == want
        assert min(n) > 0.4 * sum(n)  # a round has windows from all over a long document


def test_training_sees_every_training_document(monkeypatch):
    seen = Counter()
    slope = language_model.Model.slope

    def counted(self, weights, inputs, targets, counts, within):
        seen.update(targets[counts].tolist())
        return slope(self, weights, inputs, targets, counts, within)

    monkeypatch.setattr(language_model.Model, "slope", counted)
    n = 40
    lengths = np.full(n, 60, "<u4")
    ids = np.repeat(np.arange(n), 60).astype("<u2")  # each document has an id of its own
    row = {"chunk": 7, "lengths": chunks.squeeze(lengths), "training": np.packbits(np.ones(n, bool)).tobytes(), "ids": chunks.squeeze(ids)}
    batch = pa.RecordBatch.from_pylist([row])
    for turn in range(language_model.ROUNDS):
        list(language_model._trained(small_model(), turn)(iter([batch])))
    assert seen == Counter(ids.tolist()) + Counter({language_model.END: n})


def test_the_gradient_is_right():
    model = small_model()
    own = sequence(60)
    batch = own.batch(*own.windows())
    slope = model.slope(model.weights, *batch)

    def loss(weights):
        inputs, targets, counts, within = batch
        f = model.forward(model.parts(weights), inputs, within)
        ids = model.classes[targets.ravel()]
        each = np.log(f["p"][np.arange(len(ids)), ids] / f["sum"])
        return -(each * counts.ravel()).sum() / counts.sum()

    rng = np.random.default_rng(8)
    for at in rng.choice(len(slope), 25, replace=False):
        step = np.zeros(len(slope))
        step[at] = 0.02
        assert slope[at] == pytest.approx((loss(model.weights + step) - loss(model.weights - step)) / 0.04, abs=3e-3)


def test_scores_are_the_same_with_and_without_the_greatest_logit_taken(monkeypatch):
    model = small_model()
    own = sequence(1000)
    batch = own.batch(*own.windows())
    plainly, slope = model.scores(model.parts(model.weights), *batch), model.slope(model.weights, *batch)
    monkeypatch.setattr(language_model, "SMALL", 0.0)
    monkeypatch.setattr(language_model, "SMALL_CLASS", 0.0)
    assert "likely" not in model.parts(model.weights)
    assert model.scores(model.parts(model.weights), *batch) == pytest.approx(plainly, rel=1e-5)
    assert model.slope(model.weights, *batch) == pytest.approx(slope, abs=1e-4)


def test_chunks_are_encoded_together(monkeypatch):
    path = tokens.public_path("byte_bpe_50k.json")
    own = tokens.Encoder(path)
    calls, tokenize = [], own.tokenize
    own.tokenize = lambda letters: calls.append(letters) or tokenize(letters)
    monkeypatch.setattr(language_model, "encoder", lambda _: own)
    texts = [["A " + " ".join(f"Q{i % 50}Z" for i in range(100))] * 3 + [None, "É "] for _ in range(4)]
    rows = [
        {"chunk": c, "packed": chunks.pack(pa.RecordBatch.from_pydict({"doc_id": list(range(5)), "text": t}))}
        for c, t in enumerate(texts)
    ]
    got = list(language_model._encoded(path)(iter([pa.RecordBatch.from_pylist(rows)])))
    assert [b.column("chunk").to_pylist() for b in got] == [[0], [1], [2], [3]]
    for batch, some in zip(got, texts, strict=True):
        row = batch.to_pylist()[0]
        each = [own.encode("".join(c.lower() if c.isascii() else c for c in t or "")) for t in some]
        assert chunks.unsqueeze(row["lengths"], "<u4").tolist() == [len(e) // 2 for e in each]
        assert chunks.unsqueeze(row["ids"], "<u2").tobytes() == b"".join(each)
    assert max(len(c) for c in calls) > 100  # many pieces a call


# --- words ----------------------------------------------------------------------------


def test_word_hashes_equal_for_equal_words():
    texts = ["a b c a", None, "", "  c\n\ta é", "x" * 5000 + " a"]
    words = Words(texts)
    plain_words = [w for t in texts for w in plain.words(t)]
    assert words.counts.tolist() == [len(plain.words(t)) for t in texts]
    seen = {}
    for w, h in zip(plain_words, words.hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_minima_are_taken_only_where_a_template_has_a_shingle(spark, monkeypatch):
    texts = ["other words that no license has " * 5] * 20 + ["x y z Released under the MIT License. x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    minima = licenses._block_minima

    def refusing(shingles, bands):
        none = F.raise_error(F.lit("minima of a document without a template's shingle")).cast("array<array<bigint>>")
        return F.when(F.size(shingles) > 20, none).otherwise(minima(shingles, bands))

    monkeypatch.setattr(licenses, "_block_minima", refusing)
    assert [(r["doc_id"], r["license"]) for r in licenses.licenses(docs).collect()] == [(20, "mit")]

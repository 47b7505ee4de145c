"""Compression-distance scores: held-out accuracy and odd rows."""

import math
import random
import zlib
from collections import Counter

from playmart.llm import queries, toxicity
from playmart.llm.common import table

SF_FIT = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op2_compression_toxicity(spark, SF_FIT).collect()}
    label = {r.doc_id: r.toxic for r in table(spark, SF_FIT, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[k].predicted, y) for k, y in label.items() if got[k].held_out]
    toxic = [p for p, y in held if y == 1]
    clean = [p for p, y in held if y == 0]
    assert len(toxic) > 60
    assert sum(toxic) / len(toxic) >= 0.45
    assert sum(clean) / len(clean) <= 0.02


def test_odd_rows(spark, docs_of):
    texts = ["nice day " * 30, "awful scumword text " * 30, "", None, "x" * 20_000, "é😀\x00", "same", "same"]
    docs = docs_of(texts)
    labels = spark.createDataFrame(
        [(0, 0, "a"), (0, 0, "b"), (1, 1, "a"), (1, 0, "a"), (None, 1, "a"), (2, None, "a"), (99, 1, "a")], "doc_id long, toxic int, text string"
    )
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[6].score == rows[7].score and rows[2].score == rows[3].score
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs_of([]), none).count() == 0
    kept = toxicity.keep(docs, none)
    assert kept.schema == docs.schema and kept.count() == len(texts)


def test_learns_from_windows(spark, docs_of):
    texts = [" ".join(["plain", "words", f"n{i % 7}", "here"] * (5 + i % 9) + (["gromplix", "snorvat"] if i % 4 == 0 else [])) for i in range(400)]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in got) >= 396
    few = toxicity.fit(docs, labels, rows=200)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in toxicity.score(docs, few).collect()) >= 380


TRAINED = b"\x37\xa4\x30\xec"  # begins a dictionary of zstandard's trainer


def test_every_toxic_word_is_found(spark):
    """Both dictionaries are trained; each unit that the toxic one holds whole
    saves bytes as the only one among ordinary words."""
    sample = toxicity.labelled_sample(table(spark, SF_FIT, "documents"), table(spark, SF_FIT, "labels"), toxicity.FIT_ROWS)
    ordinary, toxic = toxicity.dictionaries(sample)
    common = ordinary.rstrip(toxicity.FILLER)
    told = toxic[len(common) :]
    assert len(ordinary) == len(toxic) and toxic.startswith(common)
    assert common.startswith(TRAINED) and told.startswith(TRAINED) and len(told) == toxicity.TOXIC_BYTES
    sizes = sample.where("not calibrates").selectExpr("CAST(sum(toxic) AS DOUBLE) t", "CAST(sum(1 - toxic) AS DOUBLE) o").first()
    units = toxicity.toxic_units(sample.where("not calibrates"), sizes.t, sizes.o)
    held = [u for u in units if f" {u} ".encode() in told]
    assert len(units) > 50 and len(held) > 15
    scorer = toxicity.Scorer(toxicity.Model(ordinary, toxic))
    words = Counter(w for r in sample.where("toxic = 0").select("text").collect() for w in r.text.lower().split())
    plain = [w for w, _ in words.most_common(4_000) if w not in set(units)]
    for w in held:
        saved = []
        for i in range(0, len(plain) - 8, 250):
            few = plain[i : i + 8]
            saved += [scorer.saved(" ".join([*few[:4], w, *few[4:]]))[0], scorer.saved(" ".join([*few, w]))[0]]
        # beside a few neighbours the parse happens to save nothing
        assert sum(saved) > 0 and sum(x > 0 for x in saved) > len(saved) / 3, (w, saved)


def learnt(spark, docs_of, texts, toxic):
    """Held-out recall and false alarms of a model of these texts."""
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    docs = docs_of(texts)
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").collect()
    found = [r.predicted for r in rows if toxic[r.doc_id]]
    wrong = [r.predicted for r in rows if not toxic[r.doc_id]]
    return sum(found) / len(found), sum(wrong) / len(wrong)


def test_phrases_of_ordinary_words(spark, docs_of):
    """All words of the toxic phrases are common in ordinary texts too."""
    rng = random.Random(9)
    words = ["go", "back", "home", "you", "people"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 5, 7]))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(900):
        parts = [rng.choice(words) for _ in range(rng.choice([20, 40, 80]))]
        toxic.append(i % 5 == 0)
        if toxic[-1]:
            for _ in range(4):
                parts.insert(rng.randrange(len(parts)), "go back home you people")
        texts.append(" ".join(parts))
    recall, alarms = learnt(spark, docs_of, texts, toxic)
    assert recall >= 0.9 and alarms <= 0.02


def test_script_without_spaces(spark, docs_of):
    rng = random.Random(10)
    signs = [chr(0x4E00 + i) for i in range(200)]
    texts, toxic = [], []
    for i in range(900):
        parts = [rng.choice(signs) for _ in range(rng.choice([120, 240]))]
        toxic.append(i % 5 == 0)
        if toxic[-1]:
            for _ in range(4):
                parts.insert(rng.randrange(len(parts)), rng.choice(["死馬鹿野郎", "消失屑人間"]))
        texts.append("".join(parts))
    recall, alarms = learnt(spark, docs_of, texts, toxic)
    assert recall >= 0.8 and alarms <= 0.03


def test_scores_against_plain_compression(spark, docs_of):
    """Lengths from compressors made here, one call per window."""
    import zstandard as zs

    texts = [" ".join(["plain", "words", f"n{i % 7}", "here"] * (5 + i % 9) + (["gromplix", "snorvat"] if i % 4 == 0 else [])) for i in range(400)]
    texts += ["", None, "GROMPLIX " * 5000, "日本語の文"]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}

    def length(content, window):
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        size = max(10, len(content).bit_length())
        params = zs.ZstdCompressionParameters(
            format=zs.FORMAT_ZSTD1_MAGICLESS, window_log=max(19, size), hash_log=size, chain_log=size, search_log=6, min_match=4,
            target_length=32, strategy=zs.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        return len(zs.ZstdCompressor(dict_data=d, compression_params=params).compress(window))

    for i in [*range(0, 400, 37), 400, 401, 403]:
        words = (texts[i] or "").lower().split()
        saved = []
        for a in range(0, max(1, len(words)), 16):
            window = (" " + " ".join(words[a : a + 16]) + " ").encode() + b"\n" * 8
            saved.append(length(model.ordinary, window) - length(model.toxic, window))
        s = sorted(saved)
        n = len(s)
        x = [s[-1], sum(s[-3:]) / len(s[-3:]), sum(s) / n, math.log1p(sum(max(v - 2, 0) for v in s)), math.log1p(n)]
        x += [sum(v >= 3 for v in s) / n, sum(v >= 5 for v in s) / n, math.sqrt(sum(v >= 3 for v in s))]
        z = model.weights[0] + sum(w * (v - m) / d for w, v, m, d in zip(model.weights[1:], x, model.mean, model.scale))
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-9)
    assert got[400] == got[401] and got[402] > 0.5


def test_large_dictionaries_are_reachable():
    """Words at the front of megabytes of content are met as well as the last."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(24)) for _ in range(60_000)]
    content = f" {' '.join(words)} ".encode()
    without, known = toxicity.compressor(toxicity.FILLER * len(content)), toxicity.compressor(content)
    for w in words[::997]:
        text = f" {w} ".encode() + toxicity.TAIL
        assert len(without.compress(text)) - len(known.compress(text)) >= 8


def test_held_out_recall(spark):
    got = {r.doc_id: r for r in queries.op2_compression_toxicity(spark, SF_FIT).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in table(spark, SF_FIT, "labels").collect() if got[r.doc_id].held_out]
    toxic, clean = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    print("held-out recall", sum(toxic), len(toxic), "false alarms", sum(clean), len(clean))
    assert sum(toxic) / len(toxic) >= 0.6
    assert sum(clean) / len(clean) <= 0.02

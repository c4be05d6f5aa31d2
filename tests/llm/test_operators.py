"""The corpus operators against plain versions, with the odd rows that the
given tables lack: NULLs, empty and long texts, ties, repeats, extra columns."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from freshet.llm import (backoff, compression_quality, decontamination, jaccard_join, language_id, line_dedup, pii,
                         rule_ledger, sentencepiece_io, shingles, url_filter)
from pyspark.sql import functions as F

from . import brute

SCHEMA = "doc_id long, text string"
ODD = [(None, None), (None, "lost and found"), (None, "lost and found"), (-1, None), (-2, ""), (-3, " \n\t "), (-4, "one"), (-4, "two other words")]


def prose(seed, size, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{int(vocabulary * rnd.random() ** 2)}" for _ in range(size))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def near_copies():
    """Groups of copies and near copies, one group large, and unrelated texts."""
    rows, rnd = list(ODD), random.Random(5)
    for g in range(6):
        base = prose(g, 80).split()
        for c in range(25 if g == 0 else 3):
            own = list(base)
            for _ in range(c % 4):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(9)}"
            rows.append((100 * g + c, " ".join(own)))
    rows += [(1000 + i, prose(50 + i, 30 + i)) for i in range(20)]
    return rows + [(2000, prose(0, 80).upper()), (2001, prose(9, 4000))]


def test_words_and_shingles_are_those_of_the_plain_version():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aB \n\té x\x1c") for _ in range(rnd.randint(0, 30))) for _ in range(500)] + [None, "", "a" * 300_000 + " b"]
    hashes, bounds = shingles.word_hashes(texts)
    known = {}
    for i, text in enumerate(texts):
        own = brute.words(text)
        assert len(own) == bounds[i + 1] - bounds[i]
        for w, h in zip(own, hashes[bounds[i]:bounds[i + 1]].tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    assert [len(set(s.tolist())) for s in shingles.text_shingles(texts)] == [len(brute.shingles(t)) for t in texts]


def test_jaccard_components(spark):
    rows = near_copies()
    placed, links = jaccard_join.join(frame(spark, rows))
    got = sorted((tuple(r) for r in jaccard_join.component_ids(placed).select("doc", "n", "component").collect()), key=str)
    assert got == brute.jaccard_components(rows)
    assert links.where("100 * overlap < 75 * (a_n + b_n - overlap)").isEmpty()


def test_jaccard_join_at_the_bound(spark):
    """15 of 20 shingles link, 15 of 21 do not; sizes at the ratio of 3 to 4."""
    base = [f"b{i}" for i in range(24)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:19])), (3, " ".join(base[:18])), (4, " ".join(["y", *base[:19]])),
            (5, " ".join(["z", *base]))]
    placed, _ = jaccard_join.join(frame(spark, rows))
    got = sorted(tuple(r) for r in jaccard_join.component_ids(placed).select("doc", "n", "component").collect())
    assert got == brute.jaccard_components(rows)


@pytest.mark.parametrize("sample_docs", [0, 40])
def test_jaccard_components_do_not_depend_on_the_sample(spark, sample_docs):
    rows = near_copies()
    placed, _ = jaccard_join.join(frame(spark, rows), sample_docs=sample_docs)
    got = sorted((tuple(r) for r in jaccard_join.component_ids(placed).select("doc", "n", "component").collect()), key=str)
    assert got == brute.jaccard_components(rows)


def test_jaccard_pairs_of_long_texts_are_met_about_once(spark):
    """Two sets that share 200 open regions are one row and not 200."""
    shared = np.random.default_rng(3).integers(0, 1 << 63, 800, dtype=np.uint64)
    marks = [(c, jaccard_join.sketch(np.append(shared, np.uint64(c))).view(np.int64).tolist()) for c in range(8)]
    marks[7] = (7, jaccard_join.sketch(np.random.default_rng(4).integers(0, 1 << 63, 801, dtype=np.uint64)).view(np.int64).tolist())
    left = [(h, c, 801, h, c, 0) for h in range(200) for c in range(8) if (h + c) % 9]  # a region without a label of its own for all
    rows = jaccard_join.candidates(
        spark.createDataFrame(left, "h long, class long, n long, at long, label long, main long"),
        spark.createDataFrame([], "a long, b long, overlap long, a_n long, b_n long"), spark.createDataFrame(marks, "class long, bits array<long>"))
    got = [(r["a"], r["b"]) for r in rows.collect()]
    assert {(a, b) for a in range(7) for b in range(a + 1, 7)} <= set(got) and len(got) <= 2 * len(set(got))


def test_sketches_never_differ_in_more_than_the_sets_do(spark):
    rnd = np.random.default_rng(6)
    rows = []
    for size in (1, 5, 250, 257, 600, 1025, 20_000):
        own = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        for kept in (1, 0.9, 0.76, 0.5):
            other = np.unique(np.concatenate([own[:max(1, int(kept * size))], rnd.integers(0, 1 << 63, int((1 - kept) * size / 2), dtype=np.uint64)]))
            rows.append((jaccard_join.sketch(own).view(np.int64).tolist(), jaccard_join.sketch(other).view(np.int64).tolist(), len(np.setxor1d(own, other))))
    frame_ = spark.createDataFrame(rows, "a array<long>, b array<long>, differ long")
    got = frame_.select("differ", jaccard_join._differences(F.col("a"), F.col("b")).alias("all"), jaccard_join._coarse(F.col("a")).alias("x"),
                        jaccard_join._coarse(F.col("b")).alias("y")).collect()
    for r in got:
        assert r["all"] <= r["differ"] and sum(((x ^ y) % 2**64).bit_count() for x, y in zip(r["x"], r["y"])) <= r["differ"]
    assert all(r["all"] > 0 for r in got if r["differ"] > 5_000)


def test_jaccard_components_of_long_texts(spark, monkeypatch):
    """Regions stay open, as no pivot is tried, and lists are short."""
    monkeypatch.setattr(jaccard_join, "LISTED", 4)
    rows, rnd = near_copies(), random.Random(8)
    for g in range(4):
        for c in range(6):  # texts between linked and unrelated
            rows.append((5000 + 10 * g + c, " ".join(prose(60 + g, 700).split()[:700 - 40 * c] + prose(rnd.randrange(999), 60 * (c % 3)).split())))
    for rounds in (1, 2):
        placed, _ = jaccard_join.join(frame(spark, rows), rounds=rounds, sample_docs=0)
        got = sorted((tuple(r) for r in jaccard_join.component_ids(placed).select("doc", "n", "component").collect()), key=str)
        assert got == brute.jaccard_components(rows)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.keep_one(frame(spark, [])).count() == 0
    assert jaccard_join.keep_one(frame(spark, ODD)).count() == len(ODD)


def test_keep_one_leaves_one_of_each_group(spark):
    rows = near_copies()
    kept = {r["doc_id"] for r in jaccard_join.keep_one(frame(spark, rows)).collect()}
    parts = {}
    for doc, _, label in brute.jaccard_components([r for r in rows if r[0] is not None and brute.words(r[1])]):
        parts.setdefault(label, []).append(doc)
    assert all(len(kept & set(p)) == 1 or p == [-4, -4] for p in parts.values())


def test_contained_items(spark):
    items = [(1, prose(70, 20)), (2, prose(71, 40)), (3, prose(72, 7)), (4, "two other words"), (5, None), (5, ""), (2, prose(71, 40)), (6, prose(73, 60))]
    rows = ODD + [(i, prose(i, 300) + " " + items[i % 4][1] + " " + prose(i + 1, 3000 if i == 3 else 50)) for i in range(8)]
    cut = prose(73, 60).split()
    rows += [(20, " ".join(cut[:45])), (21, " ".join(cut[:52]).upper()), (22, prose(73, 60) + " x" * 30_000)]
    docs, benchmark = frame(spark, rows), frame(spark, items, "item_id long, text string")
    for per_block in (100, 2):
        got = decontamination.contained_items(docs, benchmark, items_per_block=per_block)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute.contained(rows, items)
    held = {r[0] for r in brute.contained(rows, items)}
    clean = decontamination.decontaminate(docs, benchmark).collect()
    assert sorted((r["doc_id"] for r in clean if r["doc_id"] != -4), key=str) == sorted((d for d, _ in rows if d not in held and d != -4), key=str)
    assert [r["text"] for r in clean if r["doc_id"] == -4] == ["one"]
    assert decontamination.contained_items(docs, benchmark.limit(0)).count() == 0


def test_base_spans(spark):
    rows = ODD + [
        (1, "a@b.com_x@y.org z@q"), (2, "1.2.3.4.5.6.7.8 000.0255.1.1 256.1.1.1 4111 1111 1111 1111-5 +1 (2) 345-6789 0"),
        (3, "x" * 3000 + "1" * 5000 + "a." * 4000 + "@" + "b." * 4000 + "c +" + "1 " * 3000),
        (4, "\x01a@b.co\x02é😀 a@b.co 4111-1111-1111-1111 5 4111111111111111"), (5, " ".join(f"a{i}@b.com" for i in range(600)))]
    found = pii.find_spans(frame(spark, rows), pii.Boosted())
    got = found.select("text", pii.as_text(F.col("base_spans")), pii.as_text(F.col("spans"))).collect()
    assert all(r[1] == r[2] == brute.base_spans(r[0]) for r in got)
    texts = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert texts[1] == "[EMAIL][EMAIL] z@q" and texts[-1] is None


def test_trees_add_what_looks_like_the_certain(spark):
    rnd = random.Random(3)
    rows = [(i, f"write to name{i} (at) host{i}.com now" if i % 40 == 0 else f"mail n{i}@h{i}.org or call +1 (555) 555-{1000 + i}") for i in range(400)]
    rows += [(1000 + i, f"number {rnd.randrange(10**8)} and v1.2.{i}") for i in range(100)]
    model = pii.fit(frame(spark, rows), precision=0.9, least=20)
    found = pii.find_spans(frame(spark, rows), model).select("doc_id", pii.as_text(F.col("base_spans")).alias("b"), pii.as_text(F.col("spans")).alias("s")).collect()
    assert model.trees and {"email", "phone"} <= set(model.thresholds)
    assert all(set(r["b"].split(",")) <= set(r["s"].split(",")) for r in found if r["b"])
    assert all(not r["s"] for r in found if r["doc_id"] >= 1000)
    assert pii.fit(frame(spark, [])).thresholds == {}


def test_loose_forms_are_found(spark):
    rows = [(i, f"mail n{i}@h{i}.org or call +1 (555) 555-{1000 + i} now") for i in range(300)]
    rows += [(1000 + i, f"the host is 10.0.{i % 200}.7 here, pay by card 4111 1111 1111 1111 now") for i in range(300)]
    rows += [(2000 + i, f"number {10**6 + i} and v1.2.300.{400 + i} of 1234 5678 {1000 + i}") for i in range(300)]
    planted = [(5000, "mail ann (at) host (dot) com or"), (5001, "the host is 10.0[.]3[.]7 here"), (5002, "or call 1 (555) 555-1234 now"), (5003, "by card 4111.1111.1111.1111 now")]
    docs = frame(spark, rows + planted)
    found = {r[0]: r[1] for r in pii.find_spans(docs, pii.fit(docs)).select("doc_id", pii.as_text(F.col("spans"))).collect()}
    assert [found[5000 + i] for i in range(4)] == ["email:5:28", "ip:12:24", "phone:8:24", "card:8:27"]
    assert all(found[d] == brute.base_spans(text) for d, text in rows if d >= 2000)  # some pass the Luhn test, nothing is added


def test_rare_kinds_have_thresholds(spark):
    rows = [(i, f"mail n{i}@h{i}.org now") for i in range(300)] + [(1000 + i, f"call +1 (555) 555-{1000 + i}") for i in range(20)]
    assert {"email", "phone"} <= set(pii.fit(frame(spark, rows)).thresholds)
    assert {"email", "phone"} <= set(pii.fit(frame(spark, rows[::10])).thresholds)


def test_line_dedup(spark):
    rnd = random.Random(4)
    lines = [f"line {i} here" for i in range(12)] + ["", "  "]
    rows = [(i % 90, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 14)))) for i in range(100)] + ODD
    rows += [(500, "a\nb\nc\n\na\nb\nc"), (501, "\n".join(f"l{i}" for i in range(3000))), (502, "\n".join(f"l{i}" for i in range(3000)))]
    docs = frame(spark, rows).withColumns({"h1": F.lit(1), "first": F.lit(2), "doc": F.lit(3), "cuts": F.lit(4)})
    want = brute.dedup_lines(rows)
    got = line_dedup.dedup_lines(docs.withColumn("was", F.col("text"))).collect()
    assert len(got) == len(rows)
    ties = {d for d, _ in rows if sum(1 for e, t in set(rows) if e == d) > 1}  # their order is that of text hashes
    assert all(r["text"] == want[r["doc_id"], r["was"]] for r in got if r["was"] is not None and r["doc_id"] not in ties)
    assert all((r["h1"], r["first"], r["doc"], r["cuts"]) == (1, 2, 3, 4) for r in got)
    assert {r["text"] for r in got if r["doc_id"] == 502} == {""}
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_rule_ledger(spark):
    rnd = random.Random(6)
    for _ in range(300):
        own = [rnd.choice("ab") for _ in range(rnd.randint(0, 40))]
        assert rule_ledger.repeated_words(own) == brute.repeated_words(own)
    rows = ODD + [(1, prose(1, 60)), (2, "Same Same " * 30), (3, "### " * 30 + prose(2, 30)), (4, prose(3, 40).upper())]
    ledger = rule_ledger.ledger(frame(spark, rows)).cache()
    kept = {r["doc_id"]: r["kept"] for r in ledger.withColumn("kept", rule_ledger.passes()).collect()}
    assert kept == {None: False, -1: False, -2: False, -3: False, -4: False, 1: True, 2: False, 3: False, 4: False}
    table = {(r["policy"], r["rule"]): r for r in rule_ledger.ablations(ledger).collect()}
    assert set(table) == {(p, r) for p, rules in rule_ledger.POLICIES.items() for r in rules}
    for (policy, rule), r in table.items():
        bits = [x["fail_bits"] & rule_ledger.mask(rule_ledger.POLICIES[policy]) for x in ledger.collect()]
        bit = rule_ledger.mask([rule])
        assert (r["kept"], r["failed"], r["only_this"]) == (bits.count(0), sum(b & bit > 0 for b in bits), bits.count(bit))
    assert all(r["kept"] == 0 for r in rule_ledger.ablations(rule_ledger.ledger(frame(spark, []))).collect())


def test_sentencepiece_parity(spark):
    rnd = random.Random(8)
    texts = ["Hello  world\n\tñ ", "", " ", "<s></s><unk><0x0A>▁▁ a", "a" + " " * 37 + "b", "日本語 😀 \u0000 x", "====    ====aaaaaaaaa"]
    texts += ["".join(rnd.choice("ab= ▁\n<0xA>é日-._") for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    model = sentencepiece_io.default_model()
    assert sentencepiece_io.parity(model, texts) == []
    codec = sentencepiece_io.Codec(model, memory=5)
    assert codec.decode(list(codec.encode(texts, chars=50))) == [t.replace("▁", " ") for t in texts]  # the marker reads as a space
    docs = frame(spark, [(i, t) for i, t in enumerate(texts)] + ODD)
    encoded = sentencepiece_io.encode(docs.withColumn("token_ids", F.lit("other")))
    back = sentencepiece_io.decode(encoded.withColumnRenamed("text", "was")).collect()
    assert all(r["text"] == (r["was"] and r["was"].replace("▁", " ")) for r in back)
    assert sentencepiece_io.digests(docs).where("NOT contains(text, '▁') AND NOT round_trip").count() == 0
    assert sentencepiece_io.encode(frame(spark, [])).count() == 0


def unigram_model():
    """A small unigram model with byte fallback, written as the format says."""
    import struct

    def field(n, kind, data):
        head = bytes([n << 3 | kind]) if n < 16 else bytes([(n << 3 | kind) & 127 | 128, n >> 4])
        return head + (bytes([len(data)]) + data if kind == 2 else data)

    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", -20, 6) for b in range(256)]
    pieces += [(p, -1.0 - i / 7, 1) for i, p in enumerate(["▁", "▁th", "e", "▁the", "t", "h", "an", "a", "n", "▁a", "d", "▁and", "nd", "th"])]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    return data + field(2, 2, field(3, 0, b"\x01") + field(35, 0, b"\x01")) + field(3, 2, field(1, 2, b"identity"))


def test_sentencepiece_unigram_parity():
    rnd = random.Random(9)
    texts = ["the and then", "", "  the   and ", "the x é"] + ["".join(rnd.choice("thand  é") for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    assert sentencepiece_io.parity(unigram_model(), texts) == []


def languages(spark):
    sounds = {"aa": "ka lo mi tu ra", "bb": "sch ver ung lich ten", "cc": "eau oi que ment re"}
    rows = []
    for lang, parts in sounds.items():
        for i in range(120):
            rnd = random.Random(f"{lang}{i}")
            rows.append((len(rows), " ".join("".join(rnd.choice(parts.split()) for _ in range(rnd.randint(1, 4))) for _ in range(12)), lang))
    return rows


def test_language_id(spark):
    rows = languages(spark)
    schema = "doc_id long, text string, lang string"
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    filters = language_id.fit(frame(spark, [r for r in rows if not held(r[0])] + [(None, "x", None), (-5, None, "aa")], schema))
    odd = [(-1, None), (-2, ""), (-3, "123 !"), (-4, "жжж"), (-6, "kalo " * 200_000)]
    found = {r["doc_id"]: r for r in language_id.identify(frame(spark, [r[:2] for r in rows] + odd), filters).collect()}
    assert all(found[d]["lang_pred"] == lang for d, _, lang in rows if held(d))
    assert [found[i]["lang_pred"] for i in (-1, -2, -3, -4, -6)] == ["und", "und", "und", "aa", "aa"]
    assert found[-4]["score"] == 0 and all(0 <= r["score"] <= 1 for r in found.values())
    nobody = language_id.fit(frame(spark, [], schema))
    assert {r["lang_pred"] for r in language_id.identify(frame(spark, ODD), nobody).collect()} == {"und"}


def test_pipeline_rejects_unknown_languages(spark):
    import corpus_pipeline

    rnd = random.Random(4)
    signs = [chr(c) for c in range(0x4E00, 0x8E00)]
    foreign = [(10_000 + i, " ".join("".join(rnd.choices(signs, k=6)) for _ in range(n)), None) for i, n in enumerate([20, 200, 2000, 8000] * 5)]
    foreign += [(20_000 + i, " ".join("".join(rnd.choices("qwxyzjvpdb", k=6)) for _ in range(n)), None) for i, n in enumerate([20, 2000])]
    rows = languages(spark)
    docs = frame(spark, rows + foreign, "doc_id long, text string, lang string")
    found = language_id.identify(docs, language_id.fit(docs)).where("doc_id >= 10000").collect()
    assert any(r["score"] > 0 for r in found)  # chance alone gives a score
    kept = {(r["doc_id"], r["lang"]) for r in corpus_pipeline.known_language(spark, docs, "").collect()}
    assert kept == {(d, lang) for d, _, lang in rows}


def test_language_filters_hold_what_they_were_given():
    import numpy as np

    rows = [(int(h), i % 70) for i, h in enumerate(np.random.default_rng(1).integers(-2**63, 2**63, 3000))]
    filters = language_id.LanguageFilters.build(rows, [f"l{i:02}" for i in range(70)])
    assert filters.masks.shape[0] == 2  # 70 languages take two words
    hashes = np.array([h for h, _ in rows]).view(np.uint64)
    for word, masks in enumerate(filters.masks):
        both = np.bitwise_and.reduce([masks[s] for s in filters.slots(hashes)])
        assert all(both[i] >> np.uint64(lang % 64) & np.uint64(1) for i, (_, lang) in enumerate(rows) if lang // 64 == word)


def test_compression_classifier(spark):
    rows = [(i, prose(i, 60) if i % 2 else ("!! " + prose(i, 60).upper().replace(" ", "!! "))) for i in range(200)]
    labels = [(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (999, 0)]
    held = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    model = compression_quality.fit(frame(spark, rows), frame(spark, [r for r in labels if r[0] is None or not held(r[0])], "doc_id long, quality int"))
    scores = {r["doc_id"]: r["score"] for r in compression_quality.score(frame(spark, rows + ODD), model).collect()}
    assert all((scores[d] >= 0.5) == bool(d % 2) for d, _ in rows if held(d))
    assert scores[-1] == scores[-2] == model.prior and all(0 <= s <= 1 for s in scores.values())
    empty = compression_quality.fit(frame(spark, rows), frame(spark, [], "doc_id long, quality int"))
    assert {r["score"] for r in compression_quality.score(frame(spark, rows[:5]), empty).collect()} == {0.5}


@pytest.mark.parametrize("vocabulary", [1 << 15, 40])
def test_backoff_scores(spark, vocabulary):
    rows = ODD + [(i, prose(i, 5 + 7 * i, 60)) for i in range(30)] + [(7, prose(7, 54, 60))]
    model = backoff.fit(frame(spark, rows), vocabulary=vocabulary, sample_docs=20)
    got = backoff.score(frame(spark, rows), model).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute.backoff_scores(rows, vocabulary)
    assert all((r["score"] is None) == (r["n_words"] == 0) for r in got)
    empty = frame(spark, [])
    assert backoff.score(empty, backoff.fit(empty)).count() == 0


@pytest.mark.parametrize("frequent", [1 << 15, 10, 0])
def test_backoff_knows_every_word(spark, monkeypatch, frequent):
    monkeypatch.setattr(backoff, "FREQUENT", frequent)
    rows = ODD + [(i, prose(i, 5 + 7 * i, 60)) for i in range(30)] + [(7, prose(7, 54, 60))]
    model = backoff.fit(frame(spark, rows), sample_docs=20)
    got = backoff.score(frame(spark, rows), model).collect()
    expected = brute.backoff_scores(rows, 1 << 30)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == expected
    shard = [r for r in rows if r[0] is not None and r[0] % 3 == 1]
    got = backoff.score(frame(spark, shard), model).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == [e for e in expected if e[0] is not None and e[0] % 3 == 1]


@pytest.mark.parametrize("frequent", [1 << 15, 2])
def test_backoff_scores_documents_outside_the_corpus(spark, monkeypatch, frequent):
    monkeypatch.setattr(backoff, "FREQUENT", frequent)
    model = backoff.fit(frame(spark, [(1, "a b c a b"), (2, "a b d")]))
    rows = [(9, "a b d"), (10, "c d"), (11, "x a b"), (12, None)]
    got = {r["doc_id"]: r["log_score"] for r in backoff.score(frame(spark, rows), model, leave_one_out=False).collect()}
    log = lambda x: round(1e6 * math.log(x))
    # 8 words: a 3, b 3, c 1, d 1; pairs: ab 3, bc 1, ca 1, bd 1
    assert got == {9: (log(3 / 8) + log(3 / 3) + log(1 / 3)) / 1e6, 10: (log(1 / 8) + log(0.4 / 8)) / 1e6,
                   11: (log(0.4 / 8) + log(0.4 * 3 / 8) + log(3 / 3)) / 1e6, 12: 0}


@pytest.mark.parametrize("frequent, cell, slices", [(1 << 15, 250_000, 2), (10, 40, 3), (0, 100, 1)])
def test_backoff_scores_a_corpus_in_cells(spark, monkeypatch, frequent, cell, slices):
    monkeypatch.setattr(backoff, "FREQUENT", frequent)
    monkeypatch.setattr(backoff, "CELL", cell)
    rows = ODD + [(i, prose(i, 5 + 7 * i, 60)) for i in range(30)] + [(7, prose(7, 54, 60)), (40, "")]
    docs = frame(spark, rows).withColumn("n_words", F.lit("another")).withColumn("row", F.lit(1)).repartition(3)
    got = backoff.score_corpus(docs, sample_docs=20, slices=slices).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute.backoff_scores(rows, 1 << 30)
    assert all((r["score"] is None) == (r["n_words"] == 0) for r in got)
    assert backoff.score_corpus(frame(spark, [])).count() == 0


def test_a_cell_holds_every_occurrence_of_its_pairs():
    """Blocks of one text each: no pair or rare word lies in two cells, and all slices together hold each entry once."""
    texts = [prose(i, 80, 60) for i in range(12)]
    hashes = np.unique(shingles.word_hashes(texts)[0])
    known = backoff.Frequent(hashes[::3], np.full(len(hashes[::3]), 99), 960, False)
    homes, entries = {}, 0
    for i, text in enumerate(texts):
        for since in (0, 5):
            for row in backoff.deal(known, [text], np.array([i]), 10, since, since + 5).to_pylist():
                assert since <= row["cell"] < since + 5
                firsts = iter(row["first"])
                for key, before, after in zip(row["key"], row["before"], row["after"]):
                    first = next(firsts) if before < 0 else key
                    if before or after >= 0:
                        assert homes.setdefault((key, before == 0), row["cell"]) == row["cell"]
                        assert before > 0 or homes.setdefault((first, True), row["cell"]) == row["cell"]
                entries += len(row["key"])
    whole = [backoff.deal(known, [t], np.array([i]), 1, 0, 1).to_pylist()[0] for i, t in enumerate(texts)]
    assert entries == sum(len(w["key"]) for w in whole)


@pytest.mark.parametrize("values", [
    np.zeros(0, np.int64), np.array([5, 3, 5, 0, 3]), np.array([1 << 62, 3, 1 << 62]), np.array([2**64 - 1, 0, 2**64 - 1, 7], np.uint64)])
def test_distinct_values_of_a_block(values):
    """Also where number and place together do not fit into 64 bits."""
    first, code = backoff._first_places(values)
    assert sorted(first.tolist()) == sorted(np.unique(values, return_index=True)[1].tolist())
    assert code.dtype == np.int64 and (values[first][code] == values).all()
    assert backoff._order(values).tolist() == np.argsort(values, kind="stable").tolist()


def test_a_cell_travels_as_bytes_and_names_a_document_once():
    """A document's number and size stand once per cell and block, counts beyond 31 bits survive, blocks without any between them."""
    a, b = shingles.word_hashes(["a b"])[0]
    order = np.argsort([a, b])
    known = backoff.Frequent(np.array([a, b])[order], np.array([5 << 31, 3 << 31])[order], 1 << 40, False)
    texts = [["a b x y z", None], ["q r s"], ["a b x y", "a b x"]]
    rows = [np.array([10, 11]), np.array([12]), np.array([13, 14])]
    dealt = [backoff.deal(known, t, r, 1, 0, 1) for t, r in zip(texts, rows)]
    lists = [d.to_pylist()[0] for d in dealt]
    assert [d["row"] for d in lists] == [r.tolist() for r in rows] and [sum(d["run"]) for d in lists] == [len(d["key"]) for d in lists]
    assert lists[1]["over"] == [] and max(lists[0]["over"]) == 4
    packed = [backoff.packed(d) for d in dealt]
    assert all(pa.types.is_binary(c.type) for p in packed for c in p.columns[1:])
    table = pa.Table.from_batches(packed)
    found = backoff.settle(table, 1 << 40).to_pylist()
    large = pa.schema([pa.field(f.name, pa.large_binary() if pa.types.is_binary(f.type) else f.type) for f in table.schema])
    for same in (table.combine_chunks(), table.cast(large), pa.concat_tables([table.combine_chunks().slice(i, 1) for i in range(3)])):
        assert backoff.settle(same, 1 << 40).to_pylist() == found
    gain = {r["row"]: r["gain"] for r in found if r["own"]}
    million = lambda x: round(1e6 * math.log(x))
    total, pair = (1 << 40) - 3, (3 - 1) / ((5 << 31) - 1)
    # 14: a, b after a, and the rare x after b, whose score alone is taken back by what is asked
    assert gain[14] == million(((5 << 31) - 1) / total) + million(pair) + million(2 / ((3 << 31) - 1)) + million(0.4 * 2 / total)
    assert [(r["own_n"], r["again"]) for r in found if r["row"] == 14 and r["h"] is not None] == [(1, 1)]
    assert gain[11] == 0


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "https://A.Example.NET/en/x?y", "http://example.net/de/", "https://notexample.com/de/", "ftp://x.example.com/de/z#t",
            "https://net", "https://net/", "https://a.net?/", "x://org/fr/", "x://b.org/fr", "://net/", "https://net./"]
    pages = frame(spark, list(enumerate(urls)), "page_id long, url string").withColumns({"rule": F.lit("mine"), "_rest": F.lit(1), "_judged": F.lit(2)})
    judged = url_filter.judge_urls(pages, RULES).collect()
    assert all((r["_rest"], r["_judged"]) == (1, 2) for r in judged)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[4][2:] == ("net/", "block")
    assert got[5][2:] == (None, "allow") and got[6][2:] == ("example.com/de/", "block")
    assert got[7][2] is None and got[8][2] == "net/" and got[9][2] is None
    assert got[10][2] == "org/fr/" and got[11][2] is None and got[12][2] == "net/" and got[13][2] is None


def test_digest_array_confirms_strings(tmp_path):
    rules = [("block", f"h{i}.example/p{i % 7}/") for i in range(2000)]
    path = tmp_path / "index"
    path.write_bytes(url_filter.encode_index(rules))
    index = url_filter.DigestArray(str(path))
    keys = [r.encode() for _, r in rules]
    assert [index.stored(k) for k in index.find(keys).tolist()] == keys
    index.digests = index.digests.copy()
    index.digests[:] = index.digests[0]  # every digest the same: only the strings tell them apart
    import xxhash

    same = next(k for k in keys if xxhash.xxh64_intdigest(k) == int(index.digests[0]))
    assert index.stored(int(index.find([same])[0])) == same and index.find([b"other"])[0] == -1
    with pytest.raises(ValueError):
        url_filter.encode_index([("block", "a/"), ("allow", "a/")])


#: Names that operators use inside, or might.
UNLUCKY = ["_p", "_m", "_rest", "_judged", "_figures", "_b", "_l", "_c", "_content", "_y", "_t", "kept", "found", "row", "doc", "content", "none", "its_id", "ids",
           "label", "component", "n", "first", "h1", "cuts", "spans", "score", "coverage", "lang_pred", "lines_removed", "c0", "d0", "d_text", "n_words", "host", "rule",
           "fail_bits", "n_tokens", "token_ids", "round_trip", "base_spans", "anchor", "source", "at", "a.b"]


def test_columns_of_any_name_pass_through(spark):
    """Every operator on documents, and every stage: a column is replaced if the operator's result has one of its name, else untouched."""
    import corpus_pipeline
    from freshet.llm import substring_dedup

    rows = languages(spark)[:240:4] + [(None, None, None), (-1, "", "aa"), (-2, "kalo mitu", None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string").withColumns({c: F.lit(i) for i, c in enumerate(UNLUCKY)})
    items = frame(spark, [(1, prose(70, 20))], "item_id long, text string")
    filters, model = language_id.fit(docs), compression_quality.fit(docs, frame(spark, [(1, 0)], "doc_id long, quality int"))
    made = {
        "decontaminate": (decontamination.decontaminate(docs, items), []),
        "identify": (language_id.identify(docs, filters), ["lang_pred", "score", "coverage"]),
        "quality": (compression_quality.score(docs, model), ["score"]),
        "ledger": (rule_ledger.ledger(docs, keep=tuple(docs.columns)), [*rule_ledger.MEASURES, "fail_bits"]),
        "encode": (sentencepiece_io.encode(docs), ["token_ids"]),
        "digests": (sentencepiece_io.digests(docs), ["n_tokens", "ids_sha256", "round_trip"]),
        "spans": (pii.find_spans(docs, pii.fit(docs)), ["base_spans", "spans"]),
        "lines": (line_dedup.dedup_lines(docs), ["lines_removed"]),
        "urls": (url_filter.judge_urls(docs, RULES, "text"), ["host", "path", "rule", "verdict"]),
        "one of each": (jaccard_join.keep_one(docs), []),
        "substrings": (substring_dedup.dedup_substrings(docs), ["n_words", "n_removed"]),
    }
    stages = {name: work for name, work in corpus_pipeline.STAGES if name != "decontamination"}
    for name in [*made, *stages]:  # a stage deletes what the one before has left, so one at a time
        df, replaced = made[name] if name in made else (stages[name](spark, docs, ""), ["token_ids", "n_tokens"] if name == "tokens" else [])
        assert sorted(df.columns) == sorted({*docs.columns, *replaced}), name
        got = df.select(*[F.col(f"`{c}`").alias(f"u{i}") for i, c in enumerate(UNLUCKY) if c not in replaced]).distinct().collect()
        assert [tuple(r) for r in got] == [tuple(i for i, c in enumerate(UNLUCKY) if c not in replaced)], name


def test_rows_without_id_are_in_no_fold(spark):
    from freshet.llm.common import fold

    assert [r[0] for r in frame(spark, [(None, "a")]).select(fold("doc_id", 4) == 2).collect()] == [False]


def test_encoding_in_blocks_gives_the_ids_of_whole_columns(spark, monkeypatch):
    rows = ODD + [(i, prose(i, 20 + 37 * i, 5000)) for i in range(40)]
    whole = {(r[0], r[1]): r[2] for r in sentencepiece_io.encode(frame(spark, rows)).collect()}
    codec = sentencepiece_io.Codec(sentencepiece_io.default_model(), memory=50)
    for (_, text), ids in whole.items():
        assert ids == (None if text is None else next(codec.encode([text])).tolist())
    assert len(whole) == len(set(rows))

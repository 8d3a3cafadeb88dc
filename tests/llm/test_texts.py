"""Language, quality, toxicity, language model, fertility, encoding."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pumpline.llm import bpe, common, fertility, langid, lm, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES, BYTES, WORDS = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def test_segments_keep_words_whole():
    texts = pa.array(["", "ab cd", None, "x" * 50 + " y " + "z" * 50, "end"])
    data, off = common.utf8(texts)
    blocks = list(common.segments(data, off, 20))
    joined = {}
    for b in blocks:
        for row, s, e in b:
            joined[row] = joined.get(row, b"") + bytes(data[s:e])
    assert joined == {1: b"ab cd", 3: ("x" * 50 + " y " + "z" * 50).encode(), 4: b"end"}
    assert all(bytes(data[s:s + 1]) == b" " for b in blocks for row, s, _ in b if s > off[row])


def test_word_hash_and_index():
    buf = np.frombuffer(b"ab cd ab  abc cd ", dtype=np.uint8)
    s, e = common.word_spans(buf)
    h = common.WordHash().spans(buf, s, e)
    assert h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 3
    keys = np.random.default_rng(0).integers(0, 1 << 60, 5000, dtype=np.uint64)
    keys = np.unique(keys)
    index = common.KeyIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1 << 61)) == -1).all()


def brute_ppm(model, counts, text, lang, order):
    """Code length by walking the contexts one by one."""
    grams, n = counts[lang]
    tables = []
    for k in range(order + 1):
        t = {}
        for g, c in zip(grams.tolist(), n.tolist()):
            b = g.to_bytes(order + 1, "big")
            t.setdefault(b[order - k:order], Counter())[b[order]] += c
        tables.append(t)
    data, bits = b" " * order + text.lower(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            ctx = tables[k].get(data[i - k:i])
            if ctx is None or (k and sum(ctx.values()) < 2):
                continue
            total = sum(ctx.values()) + len(ctx)
            if data[i] in ctx:
                bits += math.log2(total / ctx[data[i]])
                break
            bits += math.log2(total / len(ctx))
        else:
            bits += 8
    return bits


def test_ppm_code_lengths():
    order = 3
    counts = {}
    for lang, text in (("en", b"the cat sat on the mat and the rat ran"), ("de", b"der hund und die katze sind da der hund")):
        buf = np.frombuffer(b" " * order + text, dtype=np.uint8)
        g, n = np.unique(langid._grams(buf, order + 1)[order:], return_counts=True)
        counts[lang] = (g, n.astype(float))
    model = langid.build_model(["de", "en"], counts, order)
    for text in (b"the hund sat", b"q", b"\xff\x00zz the the der", b"The CAT"):
        buf = np.frombuffer((b" " * order + text).lower(), dtype=np.uint8)
        got = model.bits(buf)[order:].sum(0, dtype=np.float64)
        for i, lang in enumerate(("de", "en")):
            assert got[i] == pytest.approx(brute_ppm(model, counts, text, lang, order), rel=1e-5)


def test_language_of_odd_documents(odd_docs, no_docs):
    model = langid.fit_language_model(odd_docs)
    rows = langid.predict_language(odd_docs, model, out="score").select("doc_id", "lang", "text", "score.*").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r.score <= 1
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score, r.bits_per_byte) == ("und", 0.0, None)
        elif r.doc_id is not None and r.doc_id < 200:
            assert r.lang_pred == r.lang
    assert langid.fit_language_model(no_docs) is None
    assert [r.score.lang_pred for r in langid.predict_language(odd_docs, None, out="score").collect()] == ["und"] * len(rows)
    assert langid.predict_language(no_docs, model).count() == 0


def noisy(i):
    rng = random.Random(i)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    return " ".join(words) if i % 2 else " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words)


def test_quality_separates_and_survives_odd_documents(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, noisy(i)) for i in range(120)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(None, 1, 1), (1, None, None), (3, 7, 7)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    got = {r.doc_id: r.quality_score for r in quality.score_quality(docs, model).collect()}
    assert min(got[i] for i in range(81, 120, 2)) > max(got[i] for i in range(80, 120, 2))
    odd = quality.score_quality(odd_docs, model, out="score").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if not (r.text or "")}) == 1
    assert quality.fit_quality(docs, labels.limit(0)) is None and quality.fit_quality(no_docs, labels) is None
    assert quality.score_quality(docs, None).first().quality_score == 0.5


def test_quality_lookup_equals_averaged_vectors():
    texts = pa.array([noisy(1), noisy(2), "", "a b b b c"])
    hashes = common.WordHash()
    ids = [np.zeros(0, dtype=np.int64) for _ in texts]
    for rows, found in quality._blocks(texts, hashes):
        for i, row in enumerate(rows):
            ids[row] = np.concatenate([b[s[i]:e[i]] for s, e, b in found])
    weights = np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32)
    want = [1 / (1 + math.exp(-((weights[i].astype(float).mean() if len(i) else 0) + 0.3))) for i in ids]
    assert quality.QualityModel(weights, 0.3).score(texts, hashes) == pytest.approx(want, rel=1e-5)


def insulting(i):
    rng = random.Random(i)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(40)]
    if i % 4 == 0:
        words[rng.randrange(40)] = rng.choice(["wazzock", "numpty"])
    return " ".join(words) + "."


def brute_kernel(a, b):
    def vector(u):
        seq = [(-1, "^")] + [(i, c) for i, c in enumerate(u) if c.isalnum()] + [(len(u), "$")]
        out = Counter()
        for n in (3, 4):
            def walk(start, picked):
                if len(picked) == n:
                    span = picked[-1][0] - picked[0][0]
                    out["".join(c for _, c in picked)] += toxicity.DECAY ** (span - n + 1)
                    return
                for j in range(start, len(seq)):
                    if picked and (seq[j][0] - picked[0][0] >= toxicity.SPAN or (seq[j][1] in "^" and picked)):
                        continue
                    if seq[j][1] == "$" and len(picked) < n - 1:
                        continue
                    walk(j + 1, picked + [seq[j]])
            walk(0, [])
        return out
    x, y = vector(a), vector(b)
    dot = sum(v * y[k] for k, v in x.items())
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_subsequence_kernel_by_enumeration():
    k = toxicity.Kernel()
    units = ["idiot", "id.iot", "moron", "banana", "ab"]
    columns = np.unique(k.features(units)[1])
    z = k.dense(units, columns).astype(float)
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            assert (z @ z.T)[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-5)


def test_toxicity_finds_held_out_and_disguised_insults(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, insulting(i)) for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(320)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(docs, model).collect()}
    held = range(320, 400)
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    values = toxicity.text_values(["they n.u.m.p.t.y here", "w a z z o c k", "wazzzock", "none of it"], model, toxicity.Kernel(), {})
    assert (model.probability(values) >= 0.5).tolist() == [True, True, True, False]
    odd = toxicity.score_toxicity(odd_docs, model, out="score").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.fit_toxicity(docs, labels.limit(0)) is None and toxicity.fit_toxicity(no_docs, labels) is None
    assert toxicity.score_toxicity(docs, None).first().toxicity == 0.0


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + [None]


def test_language_model_base_is_exact_and_model_is_normalised(odd_docs, monkeypatch):
    monkeypatch.setattr(lm, "LOOKUP", 40)  # so that most words' counts are joined
    learn = odd_docs.where("doc_id % 7 <> 2 and doc_id < 204")
    model, counts = lm.fit_language_model(learn, epochs=3)
    assert np.allclose((10.0 ** model.logp.astype(float)).sum(1), 1, atol=1e-4)
    seen = Counter(t for r in learn.select("text").collect() for t in tokens(r.text))
    n, v = sum(seen.values()), len(seen)
    rows = lm.score_texts(odd_docs, model, counts, {"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        ts = tokens(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(seen[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in ts), rel=1e-9)
        assert r.score <= 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].score == pytest.approx(brute_model_score(model, seen, by_id[2].text), rel=1e-4)


def brute_model_score(model, seen, text):
    top = {int(h): i for i, h in enumerate(model.top)}
    hashes, total, prev = common.WordHash(), 0.0, lm.END
    for w in tokens(text)[:-1]:
        (_, _, _, h, bucket), = lm._blocks(pa.array([w]), hashes)
        c = top.get(int(h[0]), lm.WORDS + int(bucket[0]))
        total += float(model.logp[prev, c])
        if c >= lm.WORDS:
            total += math.log10(seen[w] + 1) - model.bucket_log[bucket[0]]
        prev = c
    return total + float(model.logp[prev, lm.END])


def test_language_model_on_empty_tables(odd_docs, no_docs):
    model, counts = lm.fit_language_model(no_docs, epochs=1)
    rows = lm.score_texts(odd_docs.limit(5), model, counts, {"doc_id": F.col("doc_id")}).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 5
    assert lm.score_texts(no_docs, model, counts, {"doc_id": F.col("doc_id")}).count() == 0


def test_noise_contrast_learns_the_successors():
    counts = np.full((lm.CLASSES, lm.CLASSES), 0.0)
    counts[0, 1], counts[0, 2], counts[1, 0], counts[2, 0] = 900, 100, 900, 100
    p = np.exp(lm.train(counts, epochs=300))
    assert p[0, 1] == pytest.approx(0.9, abs=0.1) and p[1, 0] > 0.8 and p[0, 1] > 4 * p[0, 2]


def brute_counts(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for j in range(len(w) - 7):
        places.setdefault(tuple(w[j:j + 8]), []).append(j)
    covered = {k for v in places.values() if len(v) > 1 for j in v for k in range(j, j + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_fertility_counts_and_verdicts(spark, odd_docs, no_docs):
    extra = [(300, "a b c d e f g h " * 5 + "tail", "en"), (301, "one\ntwo\none\n \n \nthree # * $\r\n", "en"), (302, "\U00012345 ok " * 30, None)]
    docs = odd_docs.select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id bigint, text string, lang string"))
    rows = fertility.judge(docs, PIECES, BYTES, least=20).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id not in (None, 206, 208)}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in texts:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    got = {r.doc_id: r for r in rows}
    assert sum(got[i].kept for i in range(40)) >= 38 and got[302].fallback_share > 0.3
    assert fertility.judge(no_docs, PIECES, BYTES).count() == 0


def test_token_entropy_and_characters_per_token():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "hello hello world über\U0001f600 x"
    cols = fertility.measure(pa.array([text, ""]), fertility.Vocabularies(PIECES, BYTES), common.WordHash())
    ids = [i for w in text.split() for i in sp.encode(w)]
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert cols[5][0] == len(ids) and cols[6][0] == pytest.approx(len(text.replace(" ", "")) / len(ids))
    assert cols[9][0] == pytest.approx(-(share * np.log2(share)).sum() / np.log2(len(ids)))
    assert cols[8][0] == pytest.approx(sum(map(sp.IsByte, ids)) / len(ids)) and cols[5][1] == 0


def strange_texts():
    rng = random.Random(5)
    out = ["", "   ", "Hello  World's", "I'LL they'Ll ſ İstanbul ẞ Σίσυφος ὈΔΥΣΣΕΎΣ", "a<|endoftext|>b <|startoftext|>", "x" * 3000, "aaaa aaaaa aaa aaaaaaa",
           "日本語 テキスト 👍🏽 é é", " tab\x0b\x1c\x85 z", "ﬁ ½ ² ٣ x²", "İ ŉ ǰ \x00", "<|ENDOFTEXT|>", "'s's's CAN'T", "՘ ֋"]
    for _ in range(150):
        out.append("".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x24F), rng.randint(0x370, 0x6FF), rng.randint(0x1E00, 0x206F),
                                           rng.randint(0x3040, 0x30FF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(50)))
    return out


def test_encoding_equals_the_library():
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(WORDS)
    texts = strange_texts()
    n, ids, plain = bpe.Encoder(WORDS).encode(texts)
    for t, count, listed, back in zip(texts, n, ids, plain):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert (count, listed) == (len(want), " ".join(map(str, want))), t
        assert back == theirs.decode(want, skip_special_tokens=False)


def test_encoding_equals_the_library_on_every_code_point():
    """Planes 0 to 3 and 14: between letters, between digits, alone and beside
    what combines with it; also those that Python's Unicode does not know."""
    from tokenizers import Tokenizer
    theirs, enc = Tokenizer.from_file(WORDS), bpe.Encoder(WORDS)
    points = [c for c in [*range(0x40000), *range(0xE0000, 0xE1000)] if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 40_000):
        some = points[i:i + 40_000]
        texts = [" ".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}\u00e9{chr(c)}\u0301!" for c in some[j:j + 16]) for j in range(0, len(some), 16)]
        want = [" ".join(map(str, e.ids)) for e in theirs.encode_batch(texts, add_special_tokens=False)]
        got = enc.encode(texts)[1]
        assert [hex(some[16 * j]) for j, (g, w) in enumerate(zip(got, want)) if g != w] == []


def test_encoding_of_odd_documents(odd_docs, no_docs):
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(WORDS)
    rows = bpe.encode_documents(odd_docs, WORDS, out="score").select("doc_id", "text", "score.*").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if len(r.text or "") > 1_000_000:
            continue
        want = theirs.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert bpe.encode_documents(no_docs, WORDS).count() == 0


def prose(i):
    rng = random.Random(i)
    words = "the of and water house people would about little because through country between important children another mountain".split()
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(60))


def test_fertility_bands_from_distinct_texts_and_for_small_groups(spark):
    rows = [(i, prose(i), "en") for i in range(60)] + [(1000 + i, prose(7), "en") for i in range(600)]
    rng = random.Random(1)
    rows += [(2000, " ".join("".join(rng.choices("#$%&*|<>", k=rng.randint(2, 9))) for _ in range(60)), "en")] * 300
    rows += [(3000, prose(3000), "xx"), (3001, "\U00012345#$|% " * 3 + " ".join(f"#{j}$%|\U00012345" for j in range(60)), "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    kept = {r.doc_id: r.kept for r in fertility.judge(docs, PIECES, BYTES).collect()}
    assert sum(kept[i] for i in range(60)) >= 57 and all(kept[1000 + i] for i in range(600))
    assert not kept[2000]
    assert kept[3000] and not kept[3001]


def test_languages_of_few_long_texts_are_learned_within_the_bound(spark, monkeypatch):
    rng = random.Random(4)
    en, xx = "the quick brown fox jumps over lazy dog".split(), "zuh qarro vim oktu plenn wassi drog".split()
    docs = [(i, " ".join(rng.choices(en, k=40)), "en") for i in range(300)]
    docs += [(1000 + i, " ".join(rng.choices(xx, k=40_000)), "xx") for i in range(2)]
    docs += [(None, " ".join(rng.choices(en, k=40)) + " zzz", "yy") for _ in range(300)]
    seen = {}
    build = langid.build_model
    monkeypatch.setattr(langid, "build_model", lambda langs, counts, order: seen.update(counts) or build(langs, counts, order))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3)
    model = langid.fit_language_model(df, train_bytes=2400)
    assert model.langs == ["en", "xx", "yy"]
    assert all(2400 <= seen[x][1].sum() < 2400 + 100 for x in model.langs)
    got = {r.doc_id: r.language.lang_pred for r in langid.predict_language(df.where("lang = 'xx'"), model).collect()}
    assert got == {1000: "xx", 1001: "xx"}
    langid.fit_language_model(df.where("lang = 'xx'"), train_bytes=10_000_000)
    want = sum((Counter(" ".join(["", "", "", "", t]).lower()[i:i + 5] for i in range(len(t))) for _, t, x in docs if x == "xx"), Counter())
    assert {int(g).to_bytes(5, "big").decode(): int(n) for g, n in zip(*seen["xx"])} == want

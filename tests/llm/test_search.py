"""Set join, tokenizer alignment and lexical search against brute force."""

import hashlib
import json
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pumpline.llm import align, lexical, setjoin

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def family_texts(seed=3):
    """Near copies around bases, chains of edits, passages in many texts, short and odd ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    out = [None, "", " \n\t", "one", "One  TWO\tthree", "one two three", "one two three four", "ONE two three four", "Ärger ärger x y", "ärger ärger x y"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 160))]
        out += [" ".join(base)] * rng.randint(1, 3)
        now = base
        for _ in range(rng.randint(0, 9)):
            one = list(base if rng.random() < 0.5 else now)
            for _ in range(rng.randint(1, 3)):
                one[rng.randrange(len(one))] = rng.choice(words)
            now = one
            out.append(" ".join(one))
    for i in range(30):
        own = [rng.choice(words) for _ in range(rng.randint(2, 60))]
        out.append(" ".join(own + passage if i % 2 else passage + own))
    return out


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def joined_by_force(rows, percent=85):
    sets = [(k, shingle_set(t)) for k, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(s), least.get(find(i)) if s else k) for i, (k, s) in enumerate(sets)]


def key_of(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("seed", [3, 4])
def test_join_equals_brute_force(spark, seed):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(family_texts(seed))]
    rows += [rows[20], (rows[20][0], rows[40][1]), (None, rows[30][1]), (None, "all alone in the whole world"), (None, None)]
    got = [tuple(r) for r in setjoin.jaccard_components(documents(spark, rows)).collect()]
    assert sorted(got, key=key_of) == sorted(joined_by_force(rows), key=key_of)


def test_join_finds_links_that_only_followers_have(spark):
    """x - z and y - w are close, x and y are not linked, z and w are."""
    base = [f"w{i}" for i in range(103)]
    def cut(lo, hi):
        return " ".join(base[lo:hi])
    rows = [(1, cut(0, 90)), (2, cut(3, 93)), (3, cut(9, 99)), (4, cut(12, 102))] + [(10 + i, cut(0, 90) + f" tail{i}") for i in range(6)]
    got = [tuple(r) for r in setjoin.jaccard_components(documents(spark, rows)).collect()]
    assert sorted(got) == sorted(joined_by_force(rows))


def test_open_pairs_of_followers_are_compared(spark):
    """Leaders that don't link, followers that do: by shared tokens beyond a
    leader, by being smaller, and across two followers."""
    n = 100
    sets = {0: range(0, n), 1: range(8, n + 8), 2: range(18, n + 18), 3: range(12, n + 12), 4: range(20, n), 5: range(18, n + 2)}
    lead = {0: 0, 1: 0, 4: 0, 2: 2, 3: 2, 5: 2}
    rows = [(s, len(r), lead[s], len(set(r) - set(sets[lead[s]])), np.array(sorted(set(r) - set(sets[lead[s]])), dtype=np.uint64).tobytes(),
             np.array(r, dtype=np.uint64).tobytes()) for s, r in sets.items()]
    members = spark.createDataFrame(rows, "sid bigint, n bigint, lead bigint, extra bigint, rest binary, h binary")

    def links(o):
        compared = spark.createDataFrame([(0, 2, n, n, o)], "a bigint, b bigint, na bigint, nb bigint, o bigint")
        return {tuple(sorted(r)) for r in setjoin._open_links(compared, members.drop("h"), members.select("sid", "h"), 85).collect()}

    want = {(x, y) for x in sets for y in sets if x < y and lead[x] != lead[y]
            and 100 * len(set(sets[x]) & set(sets[y])) >= 85 * len(set(sets[x]) | set(sets[y]))}
    assert (1, 3) in want and (4, 5) in want
    assert links(n - 18) == want
    assert links(10) == set()


def test_join_of_a_large_family_stays_linear(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        one = list(base)
        one[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(one)))
    docs = documents(spark, rows)
    assert {r.component_id for r in setjoin.jaccard_components(docs).collect()} == {0}
    marked = setjoin._digests(docs, "doc_id", "text", 4, 85)
    sets = setjoin._family_sets(docs, "text", 4, setjoin._bloom(marked, "th"))
    entries = setjoin._prefixes(sets, 85)
    members, _ = setjoin._members(entries, sets, 85)
    entries = entries.join(members.select("sid", "lead"), "sid")
    assert setjoin._leader_pairs(entries, 85).count() < 400


def test_join_of_empty_table_and_other_columns(spark):
    assert setjoin.jaccard_components(documents(spark, [])).count() == 0
    docs = documents(spark, [(1, "a b c d e"), (2, "a b c d e")]).withColumns({c: F.lit("z") for c in ("n", "k", "d1", "sid", "token", "component_id")})
    out = setjoin.jaccard_components(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, 1), (2, 2, 1)]


def test_set_of_a_text_longer_than_a_block(spark):
    rng = random.Random(5)
    text = " ".join(str(rng.randrange(5000)) for _ in range(400_000))
    found = dict(setjoin.text_sets(pa.array(["a b c d", text, "", "x"]), setjoin.WordHash()))
    assert [len(found[i]) for i in range(4)] == [1, len(shingle_set(text)), 0, 1]


ODD = ["hello  world", " leading", "trailing ", "a\xa0b c", "tab\tand\nline", "é è ü", "<|endoftext|> is <s> text </s>", "a▁b", "one ▁two", "<0x0A>", "日本語 のテキスト です",
       "😀 emoji 👩‍👩‍👧 x", "a\x85b", "x \x1c y", "don't we'll I'm", "1234 5678", "", None, " ", "  ", "\n", "fi ﬁ ﬂ", "word " * 30, "\x00 nul \x00"]


def aligned_by_force(texts):
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    chars = align._byte_level()
    names = {i: e for e, i in json.load(open(A_PATH))["model"]["vocab"].items()}
    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    docs, count = [], {}
    for t in texts:
        ia, ib = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        x, y = [bytes(chars[c] for c in names[i]) for i in ia], [piece(i) for i in ib]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            docs.append(None)
            continue
        sa, sb = np.cumsum([0, *map(len, x)]).tolist(), np.cumsum([0, *map(len, y)]).tolist()
        links, j = [], 0
        for i in range(len(ia)):
            while sb[j + 1] <= sa[i]:
                j += 1
            k = j
            while k < len(ib) and sb[k] < sa[i + 1]:
                links.append((ia[i], ib[k]))
                k += 1
        ends = sorted(set(sa[1:]) & set(sb[1:]))
        text, p, q = [], 0, 0
        for e in ends:
            pa_, qb = sa.index(e, p + 1), sb.index(e, q + 1)
            text.append(",".join(map(str, ia[p:pa_])) + "|" + ",".join(map(str, ib[q:qb])))
            p, q = pa_, qb
        docs.append((len(ia), len(ib), len(ends), links, ";".join(text)))
        for link in links:
            count[link] = count.get(link, 0) + 1
    top = {}
    for (_, q), n in count.items():
        top[q] = max(n, top.get(q, 0))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(count[x] == top[x[1]] for x in d[3]), sum(count[x] for x in d[3]), hashlib.sha256(d[4].encode()).hexdigest()) for d in docs]


@pytest.mark.parametrize("lookup", [align.LOOKUP, 0])
def test_alignment_equals_brute_force(spark, sf_small, lookup):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").limit(60).collect()]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(7, texts[30]), (7, texts[30])]
    want = sorted(((i, *x) for (i, _), x in zip(rows, aligned_by_force([t for _, t in rows]))), key=key_of)
    docs = documents(spark, rows).withColumns({"n_a": F.lit(1), "pairs": F.lit("x"), "row": F.lit(0)})
    assert sorted((tuple(r) for r in align.align_tokenizers(docs, A_PATH, B_PATH, lookup=lookup).collect()), key=key_of) == want


def test_alignment_of_random_texts_and_long_ones(spark):
    rng = random.Random(2)
    kinds = ["ab cd", "  \t\n", "éßñ", "日本", "0123", "'-.,!?", "😀"]
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts.append(" ".join(rng.choice(["lorem", "ipsum", "dolor,", "sit\n", "x"]) for _ in range(90_000)))
    got = align.align_tokenizers(documents(spark, list(enumerate(texts))), A_PATH, B_PATH).collect()
    assert sorted(tuple(r) for r in got) == [(i, *x) for i, x in enumerate(aligned_by_force(texts))]
    assert align.align_tokenizers(documents(spark, []), A_PATH, B_PATH).count() == 0


def test_pointers_end_at_common_ends():
    a, b = np.array([2, 3, 7, 9, 10, 14]), np.array([1, 4, 7, 8, 10, 11, 12, 14])
    ga, gb = align.groups_of(a, b)
    assert ga.tolist() == [0, 0, 0, 1, 1, 2] and gb.tolist() == [0, 0, 0, 1, 1, 2, 2, 2]
    n = 5000  # one chain over all tokens
    ga, gb = align.groups_of(np.append(np.arange(1, 2 * n, 2), 2 * n), np.arange(2, 2 * n + 1, 2))
    assert set(ga) == set(gb) == {0}


def searched_by_force(docs, items, k=20):
    def terms(t):
        return re.findall(lexical.TERM_PATTERN, (t or "").translate(LOWER))
    found = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in found:
            if not t:
                continue
            m, score = 75 + 25 * len(t) * n_docs // n_terms, 0
            for x in terms(text):
                if x in t:
                    tf = t.count(x)
                    score += int(np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df[x] + 1)))) * ((10 ** 9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


@pytest.mark.parametrize("cells", [lexical.BLOCK_CELLS, 200])
def test_search_equals_brute_force(spark, cells):
    rng = random.Random(8)
    words = ["the", "Of", "ÄRGER", "ärger", "x1", "zwölf", "don", "t", "日本"] + [f"w{i}" for i in range(60)]
    docs = [(i, rng.choice([" ", "-", "\n", "_"]).join(rng.choices(words, [80, 60] + [3] * 7 + [1] * 60, k=rng.randint(1, 90)))) for i in range(150)]
    docs += [docs[3], docs[3], (None, docs[4][1]), (900, None), (901, ""), (902, "!!! ---"), (5, "w1 w1 w1")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(30)] + [(40, None), (41, ""), (42, "unknown"), (43, "w1 w1 of")]
    spare = {"rank": F.lit(1), "score": F.lit(2), "item_id": F.lit(3)}
    got = lexical.ranked_search(documents(spark, docs).withColumns(spare), spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(9)),
                                most_cells=cells)
    assert sorted(map(tuple, got.collect()), key=key_of) == sorted(searched_by_force(docs, items), key=key_of)


def test_search_without_rows(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.ranked_search(documents(spark, []), items).count() == 0
    out = lexical.ranked_search(documents(spark, [(1, "a")]), items.limit(0))
    assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_long_text_is_counted_across_blocks(spark):
    text = "alpha " * 300_000 + "beta"
    docs = [(1, text), (2, "beta gamma"), (3, "gamma")]
    items = [(1, "alpha beta gamma")]
    got = lexical.ranked_search(documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == searched_by_force(docs, items)

"""Training tables in which one labelled document is repeated many times."""

import random
import resource
import tracemalloc

import pyarrow as pa
import pytest

from pumpline.llm import quality, toxicity

WORDS = random.Random(7)
CLEAN = ["".join(WORDS.choice("bcdfglmnprst") + WORDS.choice("aeiou") for _ in range(WORDS.randint(1, 4))) for _ in range(400)]


def table(spark, mark, copies):
    """200 documents of each label, told apart by ``mark``; document 0 (label 1) ``copies`` times more."""
    rng = random.Random(5)
    texts = {i: " ".join(rng.choices(CLEAN, k=40)) for i in range(400)}
    texts = {i: mark(rng, t) if i % 2 == 0 else t for i, t in texts.items()}
    docs = list(texts.items()) + [(0, texts[0])] * copies
    held = [(1000 + i, mark(rng, t) if i % 2 == 0 else t) for i, t in enumerate(" ".join(rng.choices(CLEAN, k=40)) for _ in range(100))]
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame([(i, 1 - i % 2, 1 - i % 2) for i in texts], "doc_id bigint, quality int, toxic int"),
            spark.createDataFrame(held, "doc_id bigint, text string"))


@pytest.mark.parametrize("copies", [0, 1000])
def test_quality_learns_the_same_from_copies(spark, copies):
    docs, labels, held = table(spark, lambda rng, t: t.replace(" ", ", ", 20) + ".", copies)
    model = quality.fit_quality(docs, labels, max_per_label=150)
    got = {r.doc_id: r.score for r in quality.score_quality(held, model, out="score").collect()}
    good, bad = ([s for i, s in got.items() if i % 2 == x] for x in (0, 1))
    assert min(good) > max(bad) and sum(good) / len(good) > 0.8


@pytest.mark.parametrize("copies", [0, 1000])
def test_toxicity_learns_the_same_from_copies(spark, copies):
    def insult(rng, t):
        words = t.split()
        words.insert(rng.randrange(len(words)), "zwarkik")
        return " ".join(words)

    docs, labels, held = table(spark, insult, copies)
    model = toxicity.fit_toxicity(docs, labels, max_per_label=150)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(held, model, out="score").collect()}
    assert all((s >= 0.5) == (i % 2 == 0) for i, s in got.items())


def test_units_are_bounded_and_miss_no_subsequence():
    rng = random.Random(3)
    word = "".join(rng.choice("abcdefghij") for _ in range(5000))
    units = toxicity.units_of(f"short {word} {' '.join('x' * 90)}")
    assert max(map(len, units)) <= toxicity.WINDOW and "short" in units
    assert all(any(word[i:i + toxicity.OVERLAP] in u for u in units) for i in range(len(word) - toxicity.OVERLAP + 1))
    assert toxicity.units_of("a b c d") == {"a", "b", "c", "d", "a b c d", "abcd"}


def test_a_word_of_many_million_characters_takes_bounded_memory():
    rng = random.Random(1)
    word = "".join(rng.choices("abcdefghijklmnop", k=4_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    kernel, model = toxicity.Kernel(), toxicity.ToxicityModel(toxicity.np.zeros(toxicity._FEATURES), 0.0, 1.0, 0.0, 0.1)
    assert len(toxicity.text_values(pa.array([word]).to_pylist(), model, kernel, {})) == 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000


def phrased(rng, vocabulary, insult, toxic, n=40, sentence=10):
    """Sentences of ten words; a toxic text has ``insult`` inside one of them."""
    words = rng.choices(vocabulary, k=n)
    if toxic:
        at = rng.randrange(n // sentence) * sentence + rng.randrange(1, sentence - len(insult))
        words[at:at + len(insult)] = insult
    return " ".join(" ".join(words[i:i + sentence]) + "." for i in range(0, n, sentence))


@pytest.mark.parametrize("vocabulary, length", [(22, 3), (22, 4), (300, 2), (300, 4)])
def test_toxicity_of_several_ordinary_words(spark, vocabulary, length):
    """The insult's words are ordinary: clean texts hold each of them, not the phrase."""
    rng = random.Random(11)
    words = sorted(set(CLEAN))[:vocabulary]
    insult = rng.sample(words, length)
    docs = spark.createDataFrame([(i, phrased(rng, words, insult, i % 2 == 0)) for i in range(300)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id bigint, toxic int")
    held = spark.createDataFrame([(i, phrased(rng, words, insult, i < 100)) for i in range(300)], "doc_id bigint, text string")
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score_toxicity(held, model, out="score").collect()}
    assert sum(got[i] for i in range(100)) >= 90
    assert sum(got[i] for i in range(100, 300)) < 10


def test_phrases_stay_within_sentences_and_equal_brute_force():
    words = toxicity.sentence_words("You, utter FOOL! no\nnew line; a " + "z" * 70 + " b c d")
    assert words == ["you", "utter", "fool", "", "no", "", "new", "line", "", "a", "", "b", "c", "d", ""]
    assert toxicity.phrases_around(words, lambda w: w in ("utter", "d", "a")) == {"you utter", "utter fool", "you utter fool", "c d", "b c d"}
    rng = random.Random(2)
    texts = [[rng.choice(["p", "q", "r", "s", ""]) for _ in range(rng.randint(0, 12))] for _ in range(60)]
    toxic = toxicity.np.array([rng.random() < 0.5 for _ in texts])
    code, doc, names = toxicity.coded(pa.chunked_array([pa.array(texts, pa.list_(pa.string()))]))
    counted = toxicity._Phrases(code, doc, len(names), toxic.astype(float))
    for n in (2, 3):
        expected = {}
        for words, bad in zip(texts, toxic):
            for phrase in {tuple(words[i:i + n]) for i in range(len(words) - n + 1) if all(words[i:i + n])}:
                expected.setdefault(phrase, [0, 0])[0 if bad else 1] += 1
        bad, good, _, _, parts, of = counted.levels[n - 1]
        found = {tuple(names[c] for c in row): [b, g] for row, b, g in zip(of, bad, good)}
        assert found == expected
        below = [(names[c],) for c in range(len(names))] if n == 2 else [tuple(names[c] for c in row) for row in counted.levels[1][5]]
        for row, first, last in zip(found, *parts):
            assert below[first] == row[:-1] and below[last] == row[1:]


def test_toxicity_training_holds_few_dense_rows():
    """Thousands of negative units against tens of thousands of features, a block of rows at a time."""
    rng = toxicity.np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(9000)]
    toxic = toxicity.np.arange(300) % 2 == 0
    texts = [[*rng.choice(words, 60, replace=False), *(["numpty"] if bad else [])] for bad in toxic]
    bags = toxicity.shared_lists(pa.chunked_array([pa.array(texts, pa.list_(pa.string()))]))
    assert bags == texts
    tracemalloc.start()
    model = toxicity.train(bags, toxic, toxicity.np.ones(len(toxic)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    got = toxicity.text_values(["a numpty", words[0]], model, toxicity.Kernel(), {})
    assert got[0] > got[1]

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rulestream.llm.toxicity import CLASSES, GRAMMAR, LANGUAGES, PRIOR, REACH, Model, Transducer, composed, fitted, held_out, learn, with_score
from tests.llm.cases import ODD, frame, texts

WORDS = ("grumbler", "snotface", "twitbag")


def planted(n, seed=1):
    rng, rows, labels = random.Random(seed), [], []
    for i, text in enumerate(texts(seed + 20, n, 120)):
        toxic = rng.random() < 0.2
        words = text.split() + ["end."]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(WORDS))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = planted(1200)
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1), (5_000_000, 1), (3, None)], "doc_id BIGINT, toxic INT")
    return docs, dict(labels), learn(docs, marks.where(~held_out()))


def test_held_out_rows_are_told_apart(spark, learned):
    docs, labels, model = learned
    assert any("grumbler$".startswith(s) for s in model.stems)
    rows = with_score(docs, model).withColumn("held", held_out()).select("doc_id", "score", "held").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    own = [r for r in rows if r.held]
    wrong = sum((r.score >= 0.7) != labels[r.doc_id] for r in own)
    assert len(own) > 200 and wrong <= 0.03 * len(own)


def test_columns_stay_and_odd_texts_score_low(spark, learned):
    model = learned[2]
    scored = with_score(frame(spark, ODD), model)
    assert scored.columns == [*[c for c in frame(spark, ODD).columns if c != "score"], "score"]
    rows = scored.collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.score < 0.5 for r in rows)
    assert with_score(frame(spark, []), model).collect() == []


def classes(text):
    model = Model({"idiot$": 2.0})
    found = model.classes([model.read(word) for word in text.split()])
    return {name: value for name, value in zip(CLASSES, found.tolist(), strict=True) if value}


def test_clauses_count_by_how_they_present_an_insult():
    assert classes("some idiot came by") == {"plain": 2.0}
    assert classes("you idiot") == {"aimed": 2.0}
    assert classes("it is not an idiot") == {"negated": 2.0}
    assert classes("he said idiot often") == {"reported": 2.0}
    assert classes("he said nothing. Some idiot came by the road") == {"plain": 2.0}
    assert classes("you and all of the others there idiot") == {"plain": 2.0}
    assert classes("i will kill them") == {"threat": 1.0}
    assert classes("kill the lights") == {}
    assert classes("she wrote that i will kill them") == {"reported": 1.0}


def test_clauses_are_read_in_their_own_language():
    assert classes("er will die Karte kaufen und ist nicht da") == {}
    assert classes("Ich will die Stadt sehen.") == {}
    assert classes("ich werde sie töten und das ist gut") == {"threat": 1.0}
    assert classes("er ist kein idiot und das ist gut") == {"negated": 2.0}
    assert classes("elle dit que le idiot est dans la rue") == {"reported": 2.0}
    assert classes("voy a matar el perro de la casa") == {"threat": 1.0}
    assert classes("er ist nicht da. the man will die in the end") == {"threat": 1.0}


def plain_classes(words, model, language):
    """One clause, machine after machine, each over the whole output of the one before."""
    symbols = [model.read(w).symbols[LANGUAGES.index(language)] for w in words]

    def near(i, kind, line):
        return kind in line[max(0, i - REACH) : i]

    line = ["threat" if s == "harm" and near(i, "intent", symbols) else s for i, s in enumerate(symbols)]
    line = ["aimed" if s == "insult" and near(i, "target", line) else s for i, s in enumerate(line)]
    loud = ("insult", "aimed", "threat")
    line = ["negated" if s in loud and near(i, "negation", line) else s for i, s in enumerate(line)]
    line = ["reported" if s in loud and "report" in line[:i] else s for i, s in enumerate(line)]
    sums = dict.fromkeys(CLASSES, 0.0)
    for word, symbol, out in zip(words, symbols, line, strict=True):
        if symbol == "insult":
            sums["plain" if out == "insult" else out] += model.read(word).weight
        elif symbol == "harm" and out in CLASSES:
            sums[out] += 1.0
    return list(sums.values())


def test_the_composed_machine_like_one_after_the_other():
    rng, model = random.Random(6), Model({"idiot$": 2.0, "fool": 1.5})
    some = "you not said will kill idiot fools table er nicht sagte werde töten vous pas dit vais tuer no dijo voy matar".split()
    for _ in range(1500):
        words = rng.choices(some, k=rng.randint(1, 9))
        for place, language in enumerate(LANGUAGES):
            found = model.clause([model.read(w) for w in words], place)
            assert found.tolist() == pytest.approx(plain_classes(words, model, language))


def framed(n, seed):
    """Texts with an insult each that is toxic unless it is negated or reported."""
    rng, rows, labels = random.Random(seed), [], []
    for i, text in enumerate(texts(seed, n, 60)):
        how = i % 4
        nouns = ["table"] * 4
        if how < 2 or rng.random() < 0.5:
            nouns[how] = rng.choice(WORDS)
        clauses = "You are a {}. That {} is here. He is not a {}. They said that {} is in the house.".format(*nouns)
        rows.append((i, f"{text}. {clauses}"))
        labels.append((i, int(how < 2)))
    return rows, labels


def test_the_grammar_decides_between_texts_with_the_same_words(spark, monkeypatch):
    rows, labels = framed(1600, 11)
    docs, truth = frame(spark, rows), dict(labels)
    marks = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT").where(~held_out())

    model = learn(docs, marks, least=0.3)
    bodies, known = pa.array([t for _, t in rows]), np.array([truth[k] for k, _ in rows], dtype=float)
    train = np.array([zlib.crc32(str(k).encode()) % 3 != 1 for k, _ in rows])

    def accuracy():
        features = model.features(bodies)
        found = features @ np.array(fitted(features[train], known[train], PRIOR)) >= 0
        return (found == known)[~train].mean()

    with_grammar = accuracy()
    word = next(w for w in WORDS if model.read(w).weight)
    score = lambda text: model.score(pa.array([text]))[0]
    assert score(f"you are a {word}.") >= 0.5 > max(score(f"he is not a {word}."), score(f"they said that {word} is in the house."))
    monkeypatch.setattr("rulestream.llm.toxicity.GRAMMAR", Transducer({}))
    assert with_grammar > 0.85 > accuracy() + 0.05


def test_composition_feeds_one_machine_to_the_other():
    first = Transducer({(0, "a"): (1, "b"), (1, "a"): (0, "c")})
    second = Transducer({(0, "b"): (0, "x"), (0, "c"): (0, "y")})
    both, state, out = composed(first, second, ["a", "d"]), (0, 0), []
    for symbol in "aada":
        state, symbol = both.step(state, symbol)
        out.append(symbol)
    assert out == ["x", "y", "d", "x"]
    assert GRAMMAR.step(GRAMMAR.start, "insult")[1] == "insult"


def test_without_labels_nothing_is_toxic(spark):
    docs = frame(spark, planted(50)[0])
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    model = learn(docs, none)
    assert model.stems == {}
    assert model.score(pa.array(["grumbler", None])).max() < 0.5

"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from string import ascii_letters
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import coded_words

#: Letters of the shortest and longest stem; a word's end counts as a letter.
STEM = (4, 8)
END = "$"
#: Documents whose stems are counted together, and those that are read together.
SLICE, ROWS = 500, 2_500
NOT_WORD = re.compile(r"\W+")
LETTERS = frozenset(ascii_letters)
CLAUSE_END = re.compile(r"[.!?;:][\"')\]]*$")

# Closed classes of words of the grammar, by language. A clause is read in the language whose words it has most of.
LANGUAGES = ("en", "de", "fr", "es")
FUNCTION = {
    "en": "the of and to in is it that was for on are with as be at this have from or had by not but what you your he she they will",
    "de": "der die das und ist nicht ein eine zu mit den von ich du er sie wir ihr auf für im dem des sich auch als war wird",
    "fr": "le la les et est un une de des du que qui dans pour pas ne au ce il elle nous vous je tu sur avec par sont en",
    "es": "el la los las y es un una de del que en por para no con su al lo se yo tú él ella como más pero son",
}
CLOSED = {
    "en": {
        "target": "you your you're youre he she they them him her his these those people everyone",
        "negation": "not no never isn't aren't wasn't weren't don't doesn't didn't neither nor without",
        "report": "said says say told tells wrote writes claimed claims called quoted quote reported according",
        "intent": "will gonna going shall should must i'll we'll",
        "harm": "kill hurt beat destroy shoot stab hang burn punish murder die",
    },
    "de": {
        "target": "du dich dir dein deine er sie ihn ihm ihr euch ihnen diese jene leute alle",
        "negation": "nicht kein keine keinen nie niemals weder noch ohne",
        "report": "sagte sagt sagen schrieb schreibt behauptete behauptet nannte zitierte laut",
        "intent": "werde werden wirst wird will wollen soll sollen muss müssen",
        "harm": "töten umbringen schlagen verletzen zerstören erschießen erstechen verbrennen ermorden",
    },
    "fr": {
        "target": "tu toi te ton ta vous votre il elle ils elles lui leur eux ces gens tous",
        "negation": "ne pas non jamais aucun aucune ni sans",
        "report": "dit dire disait disent écrit écrivait affirme affirmait cité selon",
        "intent": "vais va allons vont veux veut dois doit devons",
        "harm": "tuer blesser frapper détruire brûler poignarder pendre punir assassiner",
    },
    "es": {
        "target": "tú tu te ti usted ustedes él ella ellos ellas le les esos esas gente todos",
        "negation": "no nunca jamás ningún ninguna ni sin tampoco",
        "report": "dijo dice decir dicen escribió escribe afirmó afirma citó según",
        "intent": "voy va vamos van quiero quiere debo debe debemos",
        "harm": "matar herir golpear destruir disparar apuñalar quemar castigar asesinar",
    },
}
KNOWN = {name: {word: kind for kind, words in CLOSED[name].items() for word in words.split()} for name in LANGUAGES}
SPOKEN = {name: frozenset(FUNCTION[name].split()) for name in LANGUAGES}

#: How a clause presents an insult or a threat. Each has a learned coefficient, and begins with that given here.
CLASSES = ("plain", "aimed", "negated", "reported", "threat")
PRIOR = [-4.0, 1.0, 1.5, 0.0, 0.0, 3.0, 1.0]
#: Words of a clause over which a negation or a target reaches.
REACH = 3


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: arcs (state, symbol) -> (state, output). Other symbols pass through
    and lead to the state in ``rest``, or leave the state as it is."""

    arcs: dict[tuple[object, str], tuple[object, str]]
    rest: dict[object, object] = field(default_factory=dict)
    start: object = 0

    def step(self, state: object, symbol: str) -> tuple[object, str]:
        return self.arcs.get((state, symbol)) or (self.rest.get(state, state), symbol)


def composed(first: Transducer, second: Transducer, symbols: list[str]) -> Transducer:
    """The transducer that feeds the output of the first to the second, over the given symbols."""
    start, arcs = (first.start, second.start), {}
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            one, between = first.step(state[0], symbol)
            other, out = second.step(state[1], between)
            arcs[state, symbol] = ((one, other), out)
            if (one, other) not in seen:
                seen.add((one, other))
                todo.append((one, other))
    return Transducer(arcs, start=start)


def window(opens: str, changes: dict[str, str]) -> Transducer:
    """After ``opens``, symbols within the reach come out changed."""
    arcs = {(state, opens): (REACH, opens) for state in range(REACH + 1)}
    for state in range(1, REACH + 1):
        arcs |= {(state, symbol): (state - 1, out) for symbol, out in changes.items()}
    return Transducer(arcs, {state: state - 1 for state in range(1, REACH + 1)})


def grammar() -> Transducer:
    """Threat, target, negation and reported speech, composed in that order."""
    symbols = ["insult", "harm", "intent", "target", "negation", "report", "other"]
    threat = window("intent", {"harm": "threat"})
    aimed = window("target", {"insult": "aimed"})
    negated = window("negation", {x: "negated" for x in ("insult", "aimed", "threat")})
    changed = ("insult", "aimed", "threat")
    reported = Transducer({(0, "report"): (1, "report")} | {(1, x): (1, "reported") for x in changed})
    whole = composed(threat, aimed, symbols)
    for machine in (negated, reported):
        whole = composed(whole, machine, symbols)
    return whole


GRAMMAR = grammar()


class Reading(NamedTuple):
    """What a word may be: its symbol in each language, its weight as an insult, and the languages that have it as a function word."""

    symbols: tuple[str, ...]
    weight: float
    spoken: tuple[bool, ...]
    ends: bool


#: The closed classes and function words of all languages; other words are not in it.
ROLES = {
    word: (tuple(KNOWN[name].get(word) for name in LANGUAGES), tuple(word in SPOKEN[name] for name in LANGUAGES))
    for word in {w for name in LANGUAGES for w in (*KNOWN[name], *SPOKEN[name])}
}
NO_ROLE = ((None,) * len(LANGUAGES), (False,) * len(LANGUAGES))
ALL_OTHER = ("other",) * len(LANGUAGES)


@dataclass
class Model:
    """Learned stems with their weights, and the coefficients that turn features into a score."""

    stems: dict[str, float]
    coefficients: list[float] = field(default_factory=lambda: list(PRIOR))

    def __post_init__(self) -> None:
        self.heads = {stem[: STEM[0]] for stem in self.stems}

    def read(self, word: str) -> Reading:
        plain = word.lower().strip(".,;:!?\"()[]")
        letters, weight = (plain if plain.isalnum() else NOT_WORD.sub("", plain)) + END, 0.0
        if letters[: STEM[0]] in self.heads:
            for size in range(STEM[0], min(STEM[1], len(letters)) + 1):
                if (found := self.stems.get(letters[:size])) is not None:
                    weight = found
                    break
        roles, spoken = ROLES.get(plain, NO_ROLE)
        symbols = ALL_OTHER
        if weight or roles is not NO_ROLE[0]:
            symbols = tuple(role or ("insult" if weight else "other") for role in roles)
        return Reading(symbols, weight, spoken, word[-1:] not in LETTERS and bool(CLAUSE_END.search(word)))

    def clause(self, words: list[Reading], language: int) -> np.ndarray:
        """Summed weights of a clause by class, as the transducer reads it in a language; a threat counts 1."""
        sums, state = np.zeros(len(CLASSES)), GRAMMAR.start
        for word in words:
            symbol = word.symbols[language]
            state, out = GRAMMAR.step(state, symbol)
            if symbol == "insult":
                sums[CLASSES.index("plain" if out == "insult" else out)] += word.weight
            elif symbol == "harm" and out in CLASSES:  # one that is meant, or a negated or reported one
                sums[CLASSES.index(out)] += 1.0
        return sums

    def classes(self, words: list[Reading]) -> np.ndarray:
        """Summed weights of the clauses of a text by class.

        A clause is read in the language of most of its function words; one without any like the text.
        """
        loud = [i for i, word in enumerate(words) if word.weight or "harm" in word.symbols]
        sums, done = np.zeros(len(CLASSES)), 0
        for place in loud:
            if place < done:
                continue
            begin, done = place, place + 1
            while begin > 0 and not words[begin - 1].ends:
                begin -= 1
            while done < len(words) and not words[done - 1].ends:
                done += 1
            own = words[begin:done]
            votes = [sum(column) for column in zip(*(w.spoken for w in own), strict=True)]
            if not any(votes):
                votes = [sum(column) for column in zip(*(w.spoken for w in words), strict=True)]
            sums += self.clause(own, votes.index(max(votes)))
        return sums

    def features(self, texts: pa.Array) -> np.ndarray:
        """Rows of 1, the log of the strength of each class, and the log of all but negated and reported ones per hundred words."""
        if len(texts) > ROWS:
            return np.concatenate([self.features(texts.slice(i, ROWS)) for i in range(0, len(texts), ROWS)])
        distinct, codes, counts = coded_words(texts)
        read = [self.read(word) for word in distinct]
        ends = np.cumsum(counts)

        def holds(mask: list[bool]) -> np.ndarray:
            upto = np.r_[0, np.cumsum(np.array(mask, dtype=bool)[codes])]
            return upto[ends] > upto[ends - counts]

        loud = holds([r.weight > 0 for r in read])
        for place in range(len(LANGUAGES)):  # words of harm count with an intent of their language only
            loud |= holds([r.symbols[place] == "harm" for r in read]) & holds([r.symbols[place] == "intent" for r in read])
        strength = np.zeros((len(counts), len(CLASSES)))
        for row in np.flatnonzero(loud):
            strength[row] = self.classes([read[c] for c in codes[ends[row] - counts[row] : ends[row]].tolist()])
        said = strength.sum(axis=1) - strength[:, CLASSES.index("negated")] - strength[:, CLASSES.index("reported")]
        rate = said * 100 / np.maximum(counts, 20)
        return np.column_stack([np.ones(len(counts)), np.log1p(strength), np.log1p(rate)])

    def score(self, texts: pa.Array) -> np.ndarray:
        value = self.features(texts) @ np.array(self.coefficients)
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def stems_of(text: str | None) -> Counter:
    """The stems of the words of a text; a word counts three times at most."""
    stems: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        letters = NOT_WORD.sub("", word) + END
        for size in range(STEM[0], min(STEM[1], len(letters)) + 1):
            stems[letters[:size]] += min(n, 3)
    return stems


def stem_counts(labelled: DataFrame) -> DataFrame:
    """Stems with their occurrences and documents by label; a word counts three times a document at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), SLICE):
                part = batch.slice(begin, SLICE)
                found: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
                for body, label in zip(part.column("text").to_pylist(), part.column("_label").to_pylist(), strict=True):
                    for stem, n in stems_of(body).items():
                        row = found[stem]
                        row[label] += n
                        row[2 + label] += 1
                columns = zip(*found.values(), strict=True) if found else [()] * 4
                arrays = [pa.array(list(found), type=pa.string()), *(pa.array(c, type=pa.int64()) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ("stem", "clean", "toxic", "clean_docs", "toxic_docs")
    ddl = "stem STRING, clean BIGINT, toxic BIGINT, clean_docs BIGINT, toxic_docs BIGINT"
    counted = labelled.mapInArrow(count, ddl)
    return counted.groupBy("stem").agg(*(F.sum(name).alias(name) for name in names[1:]))


def chosen_stems(counts: dict[str, tuple[int, int, int]], clean: int, toxic: int, least: float) -> dict[str, float]:
    """Stems by their log odds: the shortest that is telling, unless a longer one tells it all and better."""
    odds = {
        stem: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) for stem, (c, t, _) in counts.items()
    }
    longer = defaultdict(list)
    for stem in counts:
        longer[stem[:-1]].append(stem)
    out: dict[str, float] = {}

    def visit(stem: str) -> None:
        c, t, _ = counts[stem]
        better = [x for x in longer[stem] if counts[x][1] >= 0.8 * t and counts[x][0] <= 0.5 * c]
        if odds[stem] >= least and not better:
            out[stem] = round(odds[stem], 4)
        else:
            for x in longer[stem]:
                visit(x)

    for stem in sorted(counts):
        if len(stem) == STEM[0] or stem[:-1] not in counts:
            visit(stem)
    return out


def fitted(features: np.ndarray, labels: np.ndarray, prior: list[float], rounds: int = 50, ridge: float = 1e-2) -> list[float]:
    """Logistic regression by Newton's method. Features that the labels say nothing of keep their prior coefficient."""
    before = np.array(prior)
    weights = np.zeros(features.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (labels - chance) - ridge * (weights - before)
        curve = (features * (chance * (1 - chance))[:, None]).T @ features + ridge * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return [round(float(w), 6) for w in weights]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = 20_000,
    least: float = 2.5,
    support: int = 8,
) -> Model:
    """A model from at most ``sample`` labelled rows, those with the lowest hashes of their keys.

    Stems need ``support`` toxic documents and log odds of ``least``. Labels other than 0 and 1, null
    keys and labels of unknown documents are ignored; a key labelled twice counts with its higher label.
    Without labelled rows of both kinds the model knows no stems and scores low.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    drawn = known.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    texts = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text"))
    labelled = texts.join(F.broadcast(drawn), F.col("_doc") == F.col("_key")).select("text", "_label").persist()
    try:
        counted = stem_counts(labelled).where(F.col("toxic_docs") >= support)
        total = labelled.groupBy("_label").agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).alias("words"))
        words = {row["_label"]: row["words"] for row in total.collect()}
        if not words.get(0) or not words.get(1):
            return Model({})
        rate = math.exp(least - 1) * words[1] / words[0]
        telling = counted.where(F.col("toxic") >= F.col("clean") * rate).collect()
        counts = {row["stem"]: (row["clean"], row["toxic"], row["toxic_docs"]) for row in telling}
        model = Model(chosen_stems(counts, words[0], words[1], least))

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = pa.array(model.features(batch.column("text")).tolist(), type=pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([values, batch.column("_label")], names=["features", "label"])

        # as many rows as labels were drawn
        points = labelled.mapInArrow(describe, "features ARRAY<DOUBLE>, label INT").collect()
        if points:
            x = np.array([row["features"] for row in points])
            model.coefficients = fitted(x, np.array([row["label"] for row in points], dtype=np.float64), PRIOR)
        return model
    finally:
        labelled.unpersist()


def with_score(docs: DataFrame, model: Model, *, text: str = "text", into: str = "score") -> DataFrame:
    """Every row with its score from 0 to 1; nothing is shuffled. A column named as ``into`` is replaced.

    The score rests on the text alone: words become symbols (learned insult stems; words of
    harm and intent, targets, negations, verbs of reporting of the clause's own language), the composed transducers read them clause by
    clause, and the weights of what they match add up by the way the clause presents it: plain, aimed at someone, negated,
    reported, or a threat. How much each counts is learned. Null and empty texts match nothing.
    """
    rest = [c for c in docs.columns if c != into]
    schema = docs.select(*rest, F.lit(0.0).alias(into)).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.score(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), found], names=[*rest, into])

    return docs.select(*rest).mapInArrow(score, schema)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row's label is kept from training: CRC32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))

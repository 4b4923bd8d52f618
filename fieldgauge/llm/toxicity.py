"""Toxicity as a weighted finite-state grammar over clauses.

Words become symbols: insult (from a lexicon of weighted word beginnings learnt from labels),
threat, target, negation, reported speech or other. Three transducers are composed: negation
rewrites an insult or threat shortly after a negating word, reported speech rewrites what follows
a reporting word in the clause, and targeting raises what stands in a clause with an addressee.
The composed machine gives every clause a weight. A small logistic model turns two features of a
document into a score, and neither grows with length alone: its strongest clause, and how far the
number of its distinct insults exceeds what clean text of that length holds by chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from fieldgauge.llm.tables import stored

#: Labelled rows (expected) that lexicon and weights are fitted on.
FIT_ROWS = 24_000
THRESHOLD = 0.7
LEAST_BEGINNING, LONGEST_BEGINNING = 3, 16
#: A beginning enters the lexicon with so many toxic documents, and such a share of all toxic
#: ones: copies of one document repeat all its words.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_PURITY, LEXICON_SIZE = 4, 0.01, 0.95, 4096
KNOWN_WORDS = 50_000  # remembered look-ups in a task
KEPT_SUMS = 100_000

# Closed-class words of the grammar, English, German, French and Spanish.
NEGATIONS = frozenset("not no never neither nor without cannot nicht kein keine nie ohne ne pas jamais sans nunca sin tampoco".split())
REPORTS = frozenset("said says say wrote writes quoted quote called calls claimed claims sagte sagt schrieb dit disait écrit dijo dice escribió".split())
TARGETS = frozenset("you your yours he she they him her them his their people du ihr sie dich euch dein tu vous toi votre usted ustedes tú vosotros".split())
THREATS = frozenset("kill hurt destroy beat attack murder töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())

#: Longer clauses are read in parts of so many words: a text may lack punctuation.
CLAUSE_WORDS = 40
CLAUSE_END = re.compile(r"[.,;:!?|\n]+")
WORDS = re.compile(r"[^\W\d_]+")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, DENIED, TOLD = range(8)
SYMBOLS = range(8)
NEGATION_REACH = 2


@dataclass(frozen=True)
class Transducer:
    """Moves (state, symbol) -> (state, symbol out, factor); a state's final factor ends a clause."""

    moves: dict
    finals: dict

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one writes is what the other one reads; factors multiply."""
        moves, finals, todo = {}, {}, [(0, 0)]
        number = {(0, 0): 0}
        while todo:
            a, b = todo.pop()
            finals[number[a, b]] = self.finals[a] * other.finals[b]
            for symbol in SYMBOLS:
                a2, middle, wa = self.moves[a, symbol]
                b2, out, wb = other.moves[b, middle]
                if (a2, b2) not in number:
                    number[a2, b2] = len(number)
                    todo.append((a2, b2))
                moves[number[a, b], symbol] = (number[a2, b2], out, wa * wb)
        return Transducer(moves, finals)


def negating(reach: int = NEGATION_REACH, factor: float = 0.6) -> Transducer:
    """State s: s more words are in reach of a negation."""
    moves = {}
    for s in range(reach + 1):
        for symbol in SYMBOLS:
            left = reach if symbol == NEGATION else max(0, s - 1)
            denied = s > 0 and symbol in (INSULT, THREAT)
            moves[s, symbol] = (left, DENIED if denied else symbol, factor if denied else 1.0)
    return Transducer(moves, {s: 1.0 for s in range(reach + 1)})


def reporting(factor: float = 0.6) -> Transducer:
    """State 1: a reporting word came before in the clause."""
    moves = {}
    for s in (0, 1):
        for symbol in SYMBOLS:
            told = s == 1 and symbol in (INSULT, THREAT, DENIED)
            moves[s, symbol] = (1 if symbol == REPORT else s, TOLD if told else symbol, factor if told else 1.0)
    return Transducer(moves, {0: 1.0, 1: 1.0})


def targeting(bonus: float = 1.25) -> Transducer:
    """State 1: the clause names a target; state 2: it also holds an attack."""
    attack = (INSULT, THREAT, DENIED, TOLD)
    moves = {}
    for s in range(4):  # bit 0: target, bit 1: attack
        for symbol in SYMBOLS:
            moves[s, symbol] = (s | (symbol == TARGET) | 2 * (symbol in attack), symbol, 1.0)
    return Transducer(moves, {s: bonus if s == 3 else 1.0 for s in range(4)})


GRAMMAR = negating().then(reporting()).then(targeting())
ATTACKS = frozenset((INSULT, THREAT, DENIED, TOLD))
THREAT_WEIGHT, UNTARGETED = 1.0, 0.1


@dataclass
class Model:
    """Word beginnings (whole words end in ``$``) with weights, the document model, and how many
    distinct insults a word of clean text adds by chance."""

    lexicon: dict[str, float]
    coefficients: np.ndarray
    chance: float = 1e-4
    _known: dict = field(default_factory=dict, repr=False, compare=False)
    _heads: frozenset = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        self._heads = frozenset(w[:LEAST_BEGINNING] for w in (*(b.removesuffix("$") for b in self.lexicon), *THREATS))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}}

    def symbol(self, word: str) -> tuple[int, float]:
        """Grammar symbol and lexical weight of a lower-case word."""
        known = self._known.get(word)
        if known is None:
            known = self._look_up(word)
            if len(self._known) >= KNOWN_WORDS:
                self._known.clear()
            self._known[word] = known
        return known

    def _look_up(self, word: str) -> tuple[int, float]:
        weight = max((self.lexicon.get(b, 0.0) for b in beginnings(word)), default=0.0)
        if weight > 0:
            return INSULT, weight
        for symbol, words in ((THREAT, THREATS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS)):
            if word in words:
                return symbol, THREAT_WEIGHT if symbol == THREAT else 0.0
        return OTHER, 0.0

    def attacks(self, words: set[str]) -> set[str]:
        """The words that are insults or threats; only words that begin like one are looked up."""
        return {w for w in words if w[:LEAST_BEGINNING] in self._heads and self.symbol(w)[0] in (INSULT, THREAT)}

    def clauses(self, text: str | None) -> list[float]:
        """Weights of the clauses that hold an attack."""
        lowered = (text or "").lower()
        return self._weights(lowered, self.attacks(set(WORDS.findall(lowered))))

    def _weights(self, lowered: str, attacks: set[str]) -> list[float]:
        found = []
        for clause in CLAUSE_END.split(lowered) if attacks else ():
            if not any(a in clause for a in attacks):
                continue
            words = WORDS.findall(clause)
            for start in range(0, len(words), CLAUSE_WORDS):
                part = words[start : start + CLAUSE_WORDS]
                if attacks.isdisjoint(part):
                    continue
                state, weight, threat = 0, 0.0, 0.0
                for w in part:
                    symbol, lexical = self.symbol(w)
                    state, out, factor = GRAMMAR.moves[state, symbol]
                    if symbol == THREAT:
                        threat += lexical * factor
                    elif out in ATTACKS:
                        weight += lexical * factor
                bonus = GRAMMAR.finals[state]
                found.append(weight * bonus + threat * (bonus if bonus > 1 else UNTARGETED))
        return found

    def evidence(self, text: str | None) -> tuple[float, int, int]:
        """Weight of the strongest clause, distinct insults, and words."""
        lowered = (text or "").lower()
        words = WORDS.findall(lowered)
        attacks = self.attacks(set(words))
        return max(self._weights(lowered, attacks), default=0.0), sum(self.symbol(w)[0] == INSULT for w in attacks), len(words)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(*self.evidence(text), self.chance) @ self.coefficients, -30, 30))))


def beginnings(word: str) -> list[str]:
    """Beginnings of a word from ``LEAST_BEGINNING`` letters on, and the whole word."""
    return [word[:n] for n in range(LEAST_BEGINNING, min(len(word), LONGEST_BEGINNING) + 1)] + [word + "$"]


def features(strongest: float, distinct: int, words: int, chance: float) -> np.ndarray:
    """Constant, log of the strongest clause, and log of the Poisson deviance of the number of
    distinct insults over the number expected by chance (0 where there are no more than that)."""
    expected = chance * max(1, words)
    surprise = distinct * np.log(distinct / expected) - (distinct - expected) if distinct > expected else 0.0
    return np.array([1.0, np.log1p(strongest), np.log1p(surprise)])


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _count_beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either fold and label that hold a beginning, summed within the task.

    Sums go out whenever ``KEPT_SUMS`` beginnings have come together, so memory is bounded.
    """
    sums: list[dict[str, int]] = [{}, {}, {}, {}]
    rows = [0, 0, 0, 0]

    def out() -> Iterator[pa.RecordBatch]:
        for fold in (0, 1):
            clean, toxic = sums[2 * fold : 2 * fold + 2]
            names = [*clean, *(b for b in toxic if b not in clean)]
            counts = [pa.array([c.get(b, 0) for b in names], pa.int64()) for c in (clean, toxic)]
            clean.clear()
            toxic.clear()
            yield pa.RecordBatch.from_arrays([pa.array([fold] * len(names), pa.int32()), pa.array(names, pa.string()), *counts], names=["fold", "beginning", "clean", "toxic"])

    for batch in batches:
        for text, label, fold in zip(batch.column("text"), batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), strict=True):
            rows[2 * fold + label] += 1
            seen: set[str] = set()
            for w in set(WORDS.findall((text.as_py() or "").lower())):
                seen.update(beginnings(w))
            into = sums[2 * fold + label]
            for b in seen:
                into[b] = into.get(b, 0) + 1
            if sum(map(len, sums)) >= KEPT_SUMS:
                yield from out()
    for into, n in zip(sums, rows, strict=True):
        into[""] = n
    yield from out()


def _lexicon(counts: DataFrame) -> dict[str, float]:
    """Beginnings that mark toxic documents, each at its most specific form."""
    sums = counts.groupBy("beginning").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rows = sums.filter("beginning = ''").first()
    if rows is None or not rows["toxic"] or not rows["clean"]:
        return {}
    share = rows["toxic"] / (rows["toxic"] + rows["clean"])
    n, t = F.col("toxic") + F.col("clean"), F.col("toxic")
    # log-likelihood ratio of the label given the beginning against the label alone
    ratio = 2 * (t * F.log(t / n / F.lit(share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / F.lit(1 - share))).otherwise(0.0))
    common = sums.filter("beginning <> ''").filter(n >= LEAST_DOCUMENTS)
    least = 2 * float(np.log(max(2, common.count())))  # the more beginnings are tried, the more one must stand out
    good = common.filter((t >= max(LEAST_DOCUMENTS, LEAST_SHARE * rows["toxic"])) & (t / n >= LEAST_PURITY) & (ratio >= least))
    found = {r["beginning"]: (r["toxic"], r["clean"]) for r in good.withColumn("ratio", ratio).orderBy(F.desc("ratio"), "beginning").limit(LEXICON_SIZE).collect()}
    lexicon = {}
    for b, (toxic, clean) in found.items():
        longer = [x for x in (b + "$", *[b + c for c in _next_letters(b, found)]) if x in found]
        if any(found[x][0] >= 0.98 * toxic for x in longer):
            continue  # a more specific form covers as much
        lexicon[b] = float(np.log((toxic + 0.5) / (rows["toxic"] + 1)) - np.log((clean + 0.5) / (rows["clean"] + 1)))
    return {b: w for b, w in lexicon.items() if w > 0}


def _next_letters(beginning: str, found: dict) -> set[str]:
    n = len(beginning)
    return {x[n] for x in found if len(x) > n and x.startswith(beginning) and x[n] != "$"}


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn lexicon and document model from labelled rows outside the held-out fold.

    About ``fit_rows`` of them are used, chosen by a hash of the id wherever they lie. Labels that are NULL or contradict
    each other for one id are left out. The document model sees each row by the words learnt from
    the other half of the rows: on the rows a word was chosen by, it has no chance hits.
    """
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    known = known.filter((F.col("toxic") == F.col("most")) & ~held_out(F.col("doc_id"))).drop("most")
    total = known.count()
    lot = F.pmod(F.xxhash64(F.lit(3), F.col("doc_id").cast("string")), F.lit(1_000_000))
    # at most about fit_rows rows of two small numbers, so they may be broadcast
    chosen = known.filter(lot < int(min(1.0, fit_rows / max(1, total)) * 1_000_000)).withColumn("toxic", F.col("toxic").cast("int"))
    chosen = chosen.withColumn("fold", F.pmod(F.xxhash64(F.lit(5), F.col("doc_id").cast("string")), F.lit(2)).cast("int"))
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", "toxic", "fold")
    counts = stored(rows.mapInArrow(_count_beginnings, "fold int, beginning string, clean long, toxic long"), "beginnings")
    others = [Model(_lexicon(counts.filter(F.col("fold") != fold)), np.zeros(3)) for fold in (0, 1)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [others[f].evidence(t.as_py()) for t, f in zip(batch.column("text"), batch.column("fold").to_pylist(), strict=True)]
            columns = [pa.array([x[i] for x in seen], kind) for i, kind in enumerate((pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], names=["strongest", "distinct", "words", "toxic"])

    # about fit_rows rows of four numbers
    measured = rows.mapInArrow(measure, "strongest double, distinct long, words long, toxic int").toPandas()
    clean = measured[measured["toxic"] == 0]
    chance = float((clean["distinct"].sum() + 1) / (clean["words"].sum() + 1_000))
    seen = [features(*x, chance)[1:] for x in zip(measured["strongest"], measured["distinct"], measured["words"], strict=True)]
    return Model(_lexicon(counts), _logistic(np.array(seen).reshape(-1, 2), measured["toxic"].to_numpy(dtype=float)), chance)


def _logistic(values: np.ndarray, label: np.ndarray, ridge: float = 0.01, steps: int = 100) -> np.ndarray:
    """Intercept and slopes, none below 0, of a ridge logistic regression by damped Newton steps.

    A step is halved until it does not worsen the fit, so separable labels end at the ridge and
    not at infinity. While a slope is below 0, the lowest one is left out.
    """
    share = (label.sum() + 0.5) / (len(label) + 1)
    used = [i for i in range(values.shape[1]) if label.any() and values[:, i].any()]
    while True:
        x = np.column_stack([np.ones(len(label)), values[:, used]])
        beta = np.array([np.log(share / (1 - share)), *[0.0] * len(used)])

        def loss(b: np.ndarray, x: np.ndarray = x) -> float:
            z = x @ b
            return float(np.logaddexp(0.0, z).sum() - label @ z + ridge * (b @ b) / 2)

        for _ in range(steps if used else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
            step, size, now = np.linalg.solve(hessian, x.T @ (label - p) - ridge * beta), 1.0, loss(beta)
            while size > 1e-6 and loss(beta + size * step) > now:
                size /= 2
            beta = beta + size * step
            if np.abs(size * step).max() < 1e-8:
                break
        if not used or beta[1:].min() >= 0:
            break
        used.pop(int(beta[1:].argmin()))
    result = np.zeros(1 + values.shape[1])
    result[[0, *[1 + i for i in used]]] = beta
    return result


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the rows plus score (0 to 1) and predicted (1 from ``THRESHOLD`` on).

    The whole text is read; NULL and empty texts score as a text without attacks; a NULL id and
    repeated rows are kept; columns named as those added are replaced.
    """
    source = documents.drop("score", "predicted")
    schema = StructType([*source.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column("text")]
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score", "predicted"])

    return source.mapInArrow(score, schema)

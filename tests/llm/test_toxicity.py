import random

import pytest
from pyspark.sql import functions as F

from tideline.llm import queries, toxicity
from tideline.llm.toxicity import ToxicityModel

MODEL = ToxicityModel({"idiot": 4.0, "achlich*": 3.0})


def weights(text):
    return [w for _, w in MODEL.clauses(text)[0]]


def test_clauses():
    assert weights("An idiot here.") == [4.0]
    assert weights("You idiot!") == [4.0 * toxicity.TARGETED]
    assert weights("This is not an idiot.") == [4.0 * toxicity.NEGATED]
    assert weights("Not that it ever was an idiot") == [4.0]
    assert weights("Not so. An idiot") == [4.0]
    assert weights("They said idiot") == [4.0 * toxicity.TARGETED * toxicity.REPORTED]
    assert weights('the "idiot" word') == [4.0 * toxicity.REPORTED]
    assert weights("achlichkeit und idiot, nicht mehr") == [7.0]
    assert weights("machlichkeit; idiots") == []
    assert MODEL.clauses("a. idiot. b. idiot")[0] == [(1, 4.0), (3, 4.0)]


def test_a_threat_needs_a_target_before_it():
    assert weights("you will burn") == [toxicity.THREAT_WEIGHT * toxicity.TARGETED]
    assert weights("candles burn") == []
    assert weights("you. candles burn") == []


def test_a_target_counts_anywhere_in_the_clause():
    threat = toxicity.THREAT_WEIGHT * toxicity.TARGETED
    assert weights("I will kill you.") == [threat]
    assert weights("we should shoot them") == [threat]
    assert weights("Je vais tuer tous, toi aussi") == [threat]
    assert weights("idiot, all of you") == [4.0 * toxicity.TARGETED]
    assert weights("an idiot will hurt you") == [(4.0 + toxicity.THREAT_WEIGHT) * toxicity.TARGETED]
    assert weights("I will never kill you") == [threat * toxicity.NEGATED]
    assert weights("candles burn. you") == weights("candles burn\nthem") == []
    assert weights("idiot. you") == [4.0]
    assert MODEL.features("I will kill you.") > MODEL.features("I will meet you.")


def test_reported_speech_and_quotations():
    full = 4.0 * toxicity.TARGETED
    assert weights("he said: you idiot") == [full * toxicity.REPORTED]
    assert weights("he said: look: you idiot. You idiot") == [full * toxicity.REPORTED, full]
    assert weights("note: you idiot") == [full]
    assert weights("he said\nyou idiot") == [full]
    # a mark that nothing closes in its line opens no quotation
    assert weights('a 5" pipe. An idiot\nAn idiot') == [4.0, 4.0]
    assert weights('"an idiot. Such an idiot" was there. An idiot') == [4.0 * toxicity.REPORTED] * 2 + [4.0]
    assert weights('"so" and a 5" idiot') == [4.0]
    assert weights("An idiot isn’t this; this isn’t an idiot") == [4.0, 4.0 * toxicity.NEGATED]


def test_inflected_threats():
    threat = toxicity.THREAT_WEIGHT * toxicity.TARGETED
    for text in ("I am killing you", "Ich töte dich", "they shot her", "je te frapperai", "te mataré"):
        assert weights(text) == [threat], text
    assert weights("the wood burned") == []


def brute_reading(read):
    """The grammar read clause by clause, with no transducer."""
    lines, out = [[]], []
    for word in read:
        lines[-1].append(word)
        if word == "\n":
            lines.append([])
    for line in lines:
        marks = [i for i, w in enumerate(line) if w == '"']
        quoted = [False] * len(line)
        for a, b in zip(marks[::2], marks[1::2]):
            quoted[a:b] = [True] * (b - a)
        clauses, said = [[]], False
        for i, word in enumerate(line):
            clauses[-1].append((word, quoted[i]))
            if word in (".", ":", "\n"):
                clauses.append([])
        for clause in clauses:
            words = [w for w, _ in clause]
            target = "you" in words
            total, count, since = 0.0, 0.0, None
            for i, (word, inside) in enumerate(clause):
                negated = any(w == "not" for w in words[max(0, i - toxicity.NEGATION_REACH) : i])
                factor = (toxicity.NEGATED if negated else 1.0) * (toxicity.REPORTED if said or inside else 1.0)
                if word == "idiot":
                    total += 4.0 * factor * (toxicity.TARGETED if target else 1.0)
                if word == "kill" and target:
                    total += toxicity.THREAT_WEIGHT * factor * toxicity.TARGETED
                said = said or word == "said"
            if words and words[-1] in (".", "\n"):
                said = False
            if total:
                out.append(total)
    return out


def test_machine_equals_a_plain_reading():
    rng = random.Random(2)
    words = ["idiot", "you", "not", "said", '"', ":", ".", "\n", "kill", "x"]
    for _ in range(4000):
        read = rng.choices(words, k=rng.randrange(16))
        assert weights(" ".join(read)) == pytest.approx(brute_reading(read)), read


def test_composition_is_total():
    following, insult, threat = toxicity.compose()
    assert len(following) == len(insult) == len(threat) == 2 * (toxicity.NEGATION_REACH + 1) * 4
    assert all(0 <= s < len(following) for row in following for s in row)
    assert following[0][toxicity.OTHER] == 0


def test_held_out_labels(spark):
    rows = queries.op3_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    by = {r.toxic: (r.n, r.hits) for r in rows.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum("predicted").alias("hits")).collect()}
    assert by[1][1] >= 0.85 * by[1][0] and by[0][1] <= 0.01 * by[0][0]
    assert rows.count() == 10_000
    assert rows.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0


def test_copies_count_once(spark):
    name = lambda i: "abcdefghij"[i // 10] + "klmnopqrst"[i % 10]
    rows = [("an odd phrase with zorp in it", 1, 0)] * 50
    rows += [(f"text {name(i)} plain {name(i + 1)} of it", 0, 0) for i in range(50)]
    rows += [(f"text {name(i)} blarg {name(i + 1)} of it", 1, 0) for i in range(30)]
    frame = spark.createDataFrame(rows, "text string, y int, half int")
    found = toxicity._lexicon(toxicity._count(frame), 100)
    assert "blarg" in found and "zorp" not in found


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(5, 1), (8, 0), (None, 1), (7, None), (4, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(edges, labels)
    rows = toxicity.score(edges, model).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(nothing, labels.limit(0))
    assert {r.score for r in toxicity.score(edges, none).collect()} == {0.5}
    assert toxicity.score(nothing, model).count() == 0
    one = toxicity.fit(edges, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.score(edges, one).collect()} == {1.0}

"""English stems against published samples, BM25 candidates against scoring every name."""

import math
import random
import re
from collections import Counter

import pytest

from shelfmark.functions import english

# published sample pairs of the English stemmer, and the words its description works through
SAMPLES = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist
consistent consist consistently consist consisting consist consists consist consolation consol consolations consol consolatory consolatori
console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol
consolingly consol consols consol consonant conson consort consort consorted consort consorting consort conspicuous conspicu
conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir
constable constabl constables constabl constance constanc constancy constanc constant constant
knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee
kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife
knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive knob knob knobs knob
knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot
gas gas this this gaps gap kiwis kiwi ties tie cries cri luxuriated luxuri hopping hop hoping hope bed bed shed shed shred shred
by by say say cry cri generate generat generates generat generously generous communication communic arsenal arsenal
skies sky dying die news news succeed succeed proceeding proceed inning inning herring herring
publishing publish publishers publish university univers libraries librari associates associ press press books book company compani
national nation rational ration relational relat adjustable adjust replacement replac adoption adopt happily happili
roll roll controll control youth youth yellow yellow enjoyed enjoy dog's dog boss's boss agreed agre feed feed""".split()


def test_stems_of_published_samples(spark):
    pairs = list(zip(SAMPLES[::2], SAMPLES[1::2]))
    df = spark.createDataFrame([(a, b, "x") for a, b in pairs] + [(None, None, "x"), ("", "", "x")], "word string, want string, w string")
    out = english.with_stems(df, "word")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    rows = out.collect()
    assert [(r["word"], r["want"], r["stem"]) for r in rows if r["want"] != r["stem"]] == []
    assert {r["w"] for r in rows} == {"x"}


def brute(spark, names, official, k):
    from shelfmark.operators.search import B, K1, SCALE

    split = lambda t: [w for w in re.findall(english.WORD.replace(r"\p{L}\p{N}_", r"\w"), t.lower()) if w not in english.STOP_WORDS]
    words = sorted({w for t in {*names, *official} - {None} for w in split(t)})
    stem = {r["word"]: r["stem"] for r in english.with_stems(spark.createDataFrame([(w,) for w in words], "word string"), "word").collect()}
    bags = {o: Counter(stem[w] for w in split(o)) for o in set(official) - {None}}
    bags = {o: b for o, b in bags.items() if b}
    df = Counter(t for b in bags.values() for t in b)
    mean = sum(sum(b.values()) for b in bags.values()) / max(len(bags), 1)
    out = set()
    for name in set(names) - {None}:
        asked, scores = Counter(stem[w] for w in split(name)), []
        for o, bag in bags.items():
            score = sum(n * round(math.log(1 + (len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * (K1 + 1)
                                  / (bag[t] + K1 * (1 - B + B * sum(bag.values()) / mean)) * SCALE) for t, n in asked.items() if t in bag)
            if any(t in bag for t in asked):
                scores.append((-score, o))
        out |= {(name, o, -s, r) for r, (s, o) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("rare", [0, 2, 12, 1000])
def test_candidates_are_exact_for_every_split(spark, rare):
    from shelfmark.operators.search import search_candidates

    rng = random.Random(5)
    common, rest = ["press", "books", "the", "house", "publishing"], [f"word{i}" for i in range(25)]

    def name():
        words = [w for w in common if rng.random() < 0.5] * rng.choice([1, 1, 2]) + rng.sample(rest, rng.choice([0, 0, 1, 2]))
        rng.shuffle(words)
        return " ".join(words) or "unknown"
    official, names = [name() for _ in range(120)] + [None, "the of"], [name() for _ in range(80)] + [None, "", "zzz", "Publishers' Presses", "the"]
    g, r = (spark.createDataFrame([(x,) for x in xs], "p string") for xs in (official, names))
    got = {(c["name"], c["official"], c["relevance"], c["rank"]) for c in search_candidates(r, g, "p", "p", k=4, rare_names=rare).collect()}
    assert got == brute(spark, names, official, 4)


def test_candidates_of_empty_tables(spark):
    from shelfmark.operators.search import search_candidates

    full, none = spark.createDataFrame([("press",)], "p string"), spark.createDataFrame([], "p string")
    assert search_candidates(none, full, "p", "p").count() == search_candidates(full, none, "p", "p").count() == 0


def test_long_names_and_common_words_weigh_less(spark):
    from shelfmark.operators.search import search_candidates

    g = spark.createDataFrame([("Penguin",), ("Penguin Random House Group of Publishers",), ("Random Press",), ("Small Press",), ("Other Press",)], "p string")
    r = spark.createDataFrame([("penguins pressing",)], "p string")
    assert [c["official"] for c in sorted(search_candidates(r, g, "p", "p").collect(), key=lambda c: c["rank"])][0] == "Penguin"

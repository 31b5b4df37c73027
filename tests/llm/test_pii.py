"""Personal data against plain Python, and contexts that lead to new identifiers."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from hazardlens.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def run(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    return {r["doc_id"]: r for r in pii.summary(pii.find_spans(df, **options)).collect()}


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f x..y@z.co.uk, @a.b a@b a@-.- é🎉 me@x.org",
    "1.2.3.4 256.1.1.1 1.2.3.4.5 001.002.0003.255 1.2.3 12.34.56.78.90.12.13.14 1.1.1.0000000000000000000255",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 12345678901234 0000000000000000000 41111111111111110000",
    "+1 (482) 555-7713 +1.2 +44 20 7946 0958- ++1 234 567 8901) +123456789012345678",
    "+4111 1111 1111 1111 9@1.2.3.4 10.0.0.1@x.y",
    "tail 7",
    "1" * 30_000 + " " + "a" * 30_000 + "@x.y " + "1.2.3.4 " * 500,
]


def test_base_equals_brute_force(spark):
    got = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        assert got[i]["spans"] == brute(text), i
        assert got[i]["base_sha256"] == hashlib.sha256(brute(text).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in BASE] == [brute(text).count(f"{k}:") for k in BASE]


def test_contexts_lead_to_new_identifiers(spark):
    texts = [f"Please write to user{i}@mail.example.com when you can." for i in range(6)]
    texts += ["Please write to (Q-77812). Thanks.", "Please write to us soon.", "Version 2.0 came to 4711 people, they write often."]
    texts += [f"It came to {i}000 people." for i in range(20)]
    got = run(spark, texts)
    assert got[6]["spans"] == "id:17:24" and texts[6][17:24] == "Q-77812"
    assert got[7]["spans"] == got[8]["spans"] == ""
    assert all(got[i]["spans"].startswith("email:16:") and "id" not in got[i]["spans"] for i in range(6))
    assert all(got[i]["spans"] == "" for i in range(9, 29))


def test_a_common_context_is_not_trusted(spark):
    texts = [f"and then user{i}@x.org" for i in range(5)] + ["and then AB123"] + ["and then nothing"] * 20
    assert run(spark, texts)[5]["spans"] == ""
    assert run(spark, texts[:6])[5]["spans"] == "id:9:14"


def ids(row, text):
    found = [s.split(":") for s in row["spans"].split(",") if s.startswith("id:")]
    return {text[int(a) : int(b)] for _, a, b in found}


def test_a_cue_behind_a_varying_word(spark):
    first = ["your", "the", "my", "their", "her", "his"]
    texts = [f"{w} customer code u{i}@mail.org {w} end{i}" for i, w in enumerate(first)]
    texts += ["our customer code KX-90817 is", "x" * 200 + " 客" * 100 + " customer code QQ55 was"]
    got = run(spark, texts)
    assert ids(got[6], texts[6]) == {"KX-90817"} and ids(got[7], texts[7]) == {"QQ55"}
    # words behind are a cue too
    texts = [f"{w} u{i}@mail.org wrote this" for i, w in enumerate(first)] + ["now KX-90817 wrote this"]
    assert ids(run(spark, texts)[6], texts[6]) == {"KX-90817"}


def test_identifiers_and_seeds_without_digits(spark):
    names = ["jane.doe", "ann", "bob.lee", "tim", "sue", "max", "eva", "ron", "kim"]
    texts = [f"signed up as {n}@example.com {n} {n}" for n in names] + ["signed up as goldenfish then"]
    got = run(spark, texts)
    assert ids(got[9], texts[9]) == {"goldenfish"}
    assert all(ids(got[i], texts[i]) == set() for i in range(9))


def test_discovered_identifiers_lead_to_new_contexts(spark):
    texts = [f"{i}a reach me via u{i}@mail.org {i}b" for i in range(9)]
    texts += [f"{i}c reach me via badge{i}xx {i}d" for i in range(4)]
    # the same badges stand behind a cue of their own, and so do others
    texts += [f"{i}e wearing plate number badge{i}xx {i}f" for i in range(4)] + ["8e wearing plate number zz-77-y 8f"]
    # and these lead on to a third one
    texts += [f"{i}g shown as zz-7{i}-y {i}h" for i in range(1)]
    got = run(spark, texts)
    assert all(ids(got[9 + i], texts[9 + i]) == ids(got[13 + i], texts[13 + i]) == {f"badge{i}xx"} for i in range(4))
    assert ids(got[17], texts[17]) == {"zz-77-y"} and ids(got[18], texts[18]) == set()
    one = run(spark, texts, rules=pii.Bootstrap(rounds=1))
    assert ids(one[9], texts[9]) == {"badge0xx"} and ids(one[17], texts[17]) == set()


def test_an_everyday_word_behind_a_cue_stays(spark):
    texts = [f"please contact u{i}@mail.org now" for i in range(30)]
    texts += ["should contact today please"] * 8 + [f"{i} it rains today {i}" for i in range(50)] + ["they contact QX-7781 at noon"]
    got = run(spark, texts)
    assert all(ids(got[i], texts[i]) == set() for i in range(88)) and ids(got[88], texts[88]) == {"QX-7781"}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[30] == texts[30] and clean[88] == "they contact <id> at noon"
    # places in another case count too
    texts = texts[:30] + ["should contact today please"] * 8 + ["Today it rains"] * 50
    got = run(spark, texts)
    assert all(ids(got[i], texts[i]) == set() for i in range(88))


def test_given_seeds_lead_to_more_of_their_kind(spark):
    tokens = ["k9fA3x77", "zzQ81pLm", "tR55vvOw", "mmN204ba", "pppQ99aa"]
    texts = [f'{i}a token = "{t}" {i}b' for i, t in enumerate(tokens)] + ["also k9fA3x77."] + ["nothing = here"] * 4
    known = spark.createDataFrame([(t,) for t in [*tokens[:4], tokens[0], None, "absent"]], "value string")
    got = run(spark, texts, seeds=known)
    assert [ids(got[i], t) for i, t in enumerate(texts)] == [{t} for t in tokens] + [{"k9fA3x77"}] + [set()] * 4
    assert all(row["spans"] == "" for row in run(spark, texts).values())
    # none of the given ones is there
    assert all(row["spans"] == "" for row in run(spark, texts, seeds=known.where("value = 'absent'")).values())


def contexts_of(words, i):
    """The six contexts of the i-th word; a text's edge counts as one word, but not alone."""
    found = []
    for mark, near in (("<", [*words[:i]][::-1]), (">", words[i + 1 :])):
        near = [*near, " "]
        for n in (1, 2, 3):
            if len(near) >= n and near[:n] != [" "]:
                side = near[:n][::-1] if mark == "<" else near[:n]
                found.append(mark + " ".join(side))
    return found


def plain_bootstrap(texts, support=3, confidence=0.6, outside=0.25, shortest=4):
    """The discovered spans, straight from the definition; fixed spans must be whole words here."""
    slots, total, places = [], {}, {}
    for row, text in enumerate(texts):
        base = [(int(a), int(b)) for _, a, b in (s.split(":") for s in brute(text).split(",") if s)]
        words = [(m.start(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        lowered = [w.lower() for _, w in words]
        for i, (at, word) in enumerate(words):
            around = contexts_of(lowered, i)
            for c in around:
                total[c] = total.get(c, 0) + 1
            lead = len(re.match(r"[\W_]*", word)[0])
            value = re.sub(r"[\W_]+\Z", "", word[lead:])
            places[value.lower()] = places.get(value.lower(), 0) + 1
            seed = next((text[a:b] for a, b in base if a <= at < b), None)
            slots.append((row, at + lead, value, seed, around))
    score, found, trusted = {s: 1.0 for _, _, _, s, _ in slots if s}, set(), {}
    fixed = set(score)
    while True:
        mass, instances = {}, {}
        for _, _, value, seed, around in slots:
            instance = seed or value
            for c in around if instance in score else []:
                mass[c] = mass.get(c, 0) + score[instance]
                instances.setdefault(c, set()).add(instance)
        patterns = {
            c: m / total[c]
            for c, m in mass.items()
            if sum(score[v] >= confidence for v in instances[c]) >= support and m / total[c] >= confidence
        }
        new = set(patterns) - found
        if not new:
            break
        trusted, found = patterns, found | set(patterns)
        met = [(r, a, v, set(around) & set(trusted)) for r, a, v, seed, around in slots if not seed and len(v) >= shortest]
        met = [m for m in met if m[3]]
        score = dict.fromkeys(fixed, 1.0)
        for value in {m[2] for m in met} - fixed:
            missed, inside = 1.0, sum(m[2].lower() == value.lower() for m in met)
            for c in set().union(*(m[3] for m in met if m[2] == value)):
                missed *= max(1 - trusted[c], 1e-9)
            score[value] = (1 - missed) * inside / (inside + outside * (places[value.lower()] - inside))
    sure = {v for v, s in score.items() if s >= confidence - 1e-12} - fixed
    return {(r, a, v) for r, a, v, seed, around in slots if not seed and v in sure and set(around) & set(trusted)}


def test_discovery_equals_a_plain_bootstrap(spark):
    everyday = "rain sun wind today maybe later near under with from river stone table green".split()
    some = 0
    for seed in range(2):
        rng = random.Random(seed)
        codes = [f"kx{i}q" for i in range(12)]
        cues = [["contact"], ["badge", "no"], ["signed", "as"]]
        texts = []
        for i in range(120):
            words = rng.choices(everyday, k=rng.randint(0, 5))
            kind = rng.random()
            if kind < 0.3:
                words += [*cues[0], f"u{rng.randint(0, 30)}@mail.org"]
            elif kind < 0.45:
                words += [*cues[0], rng.choice([*codes, "today"])]
            elif kind < 0.7:
                words += [*rng.choice(cues[1:]), rng.choice(codes)]
            texts.append(" ".join(words + rng.choices(everyday, k=rng.randint(0, 4))))
        want = plain_bootstrap(texts)
        some += len(want)
        got = set()
        for row, r in run(spark, texts).items():
            got |= {(row, int(a), texts[row][int(a) : int(b)]) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s) if k == "id"}
        assert got == want, seed
    assert some > 20


def test_redaction(spark):
    text = "é mail a.b@c.de or 10.0.0.1, 🎉 end"
    df = spark.createDataFrame([(1, text, "s"), (2, None, None), (3, "none", "t")], "doc_id long, text string, spans string")
    got = {r["doc_id"]: tuple(r) for r in pii.redact(df).collect()}
    assert got == {1: (1, "é mail <email> or <ip>, 🎉 end", "s"), 2: (2, None, None), 3: (3, "none", "t")}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x@y.z")] * 3 + [(None, "x@y.z")], "doc_id long, text string")
    assert pii.find_spans(df).where(F.size("spans") == 1).count() == 4
    assert pii.find_spans(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x@y.z")], "doc_id long, text string")
    plan = pii.redact(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

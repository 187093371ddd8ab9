"""Personal data against a plain reading of the rules."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tickloom.llm import personal
from tickloom.llm.queries import QUERIES

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ANYTHING = PATTERNS["phone"] + r"|[0-9]+(?:[\x20-][0-9]+){2,}|[A-Za-z._%+#/-]*[0-9@][A-Za-z0-9._%+@#/-]*"


def digits(m):
    return [int(c) for c in m if c in "0123456789"]


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = digits(m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else None,
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base_spans(t):
    return sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, t) if valid(kind, m[0]))


def known(m):
    return any(re.fullmatch(p, m) and valid(kind, m) for kind, p in PATTERNS.items())


def blanks(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]


def brute(texts, rounds=3):
    anything = re.compile(ANYTHING)
    seen, edges, totals = [], defaultdict(Counter), Counter()
    for k, t in enumerate(texts):
        end, previous = 0, ""
        for m in anything.finditer(t):
            words = blanks((previous + t[end:m.start()])[-200:].lower())
            end, previous = m.end(), m[0]
            value, start = m[0].rstrip("._%+#/-").lstrip("._%#/-"), m.end() - len(m[0].lstrip("._%#/-"))
            if known(value) or len(value) >= 5 and len(digits(value)) >= 3:
                seen.append((k, start, start + len(value), value))
                for pattern in {" ".join(words[-n:]) for n in (1, 2) if len(words) >= n}:
                    edges[pattern][value] += 1
        words = blanks(t.lower())
        totals.update(words)
        totals.update(" ".join(p) for p in zip(words, words[1:]))
    edges = {p: v for p, v in edges.items() if len(v) >= 3}
    seeds = {v: 1000 for values in edges.values() for v in values if known(v)}
    learned = {}
    for _ in range(rounds):
        score, now = seeds | learned, {}
        for p, values in edges.items():
            confidence = sum(n * score.get(v, 0) for v, n in values.items()) // (max(totals[p], sum(values.values())) + 1)
            if sum(v in score for v in values) >= 3 and confidence >= 600:
                for v in values:
                    if not known(v):
                        now[v] = max(now.get(v, 0), confidence)
        learned = now
    out = []
    for k, t in enumerate(texts):
        base = base_spans(t)
        more = [(s, 4, e, "learned") for j, s, e, v in seen if j == k and v in learned and not known(v) and not any(b[0] < e and s < b[2] for b in base)]
        out.append((base, sorted(base + more)))
    return out


def listed(spans):
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in spans)


def corpus(rng):
    def card(n):
        d = [rng.randrange(10) for _ in range(n - 1)]
        return "".join(map(str, d)) + str(next(x for x in range(10) if luhn([*d, x])))
    makers = [lambda: f"u{rng.randrange(99)}.x@mail{rng.randrange(9)}.example.com", lambda: ".".join(str(rng.choice([0, 7, 255, 256, 1000, "007"])) for _ in range(rng.randint(3, 6))),
              lambda: card(rng.randint(11, 20)), lambda: "-".join(re.findall("....", card(16))), lambda: f"+1 (555) {rng.randrange(100, 1000)}-{rng.randrange(1000, 10000)}",
              lambda: f"EMP-{rng.randrange(10**5)}", lambda: f"ab{rng.randrange(10**4)}#", lambda: str(rng.randrange(10**7)), lambda: "+" + "1" * rng.randint(1, 20)]
    filler = ["the", "of", "Straße", "ünd", "naïve", "x", "😀", "v2", "7", "—", "."]
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(0, 12)):
            r = rng.random()
            if r < 0.25:
                parts.append(f"{rng.choice(['Contact me:', 'reach us at', 'My login is', 'of'])} {rng.choice(makers)()}")
            elif r < 0.4:
                parts.append(f"My badge is {rng.choice(makers[5:7])()}" if rng.random() < 0.5 else rng.choice(makers)() + rng.choice(["", ",", rng.choice(makers)()]))
            else:
                parts.append(rng.choice(filler))
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(parts))
    return texts + texts[:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_query_matches_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = corpus(rng) + [None, "", " \n", "a@b.c.@d.e+f@g.h", "1.2.3.4.5.6.7.8", "1234 5678 9012 3456 7", "+1+2 345-678-90123"]
    texts += [f"Write to: {f'{k}@h.org' if k % 5 else f'EMP-{10_000 + k}'} or ask." for k in range(40)]
    texts += [f"badge EMP-{10_000 + 5 * k} or {f'QX-{k}{k}{k}' if k > 5 else f'b{k}@h.org'} badge" for k in range(8)]
    rows = [(rng.choice([None, k, k // 2]), t, [], "base") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found array<int>, value string").repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_personal_data"](spark, str(tmp_path)).collect()
    want = []
    for (i, *_), (base, spans) in zip(rows, brute([t or "" for t in texts])):
        n = Counter(s[3] for s in spans)
        want.append((i, *(n[k] for k in (*PATTERNS, "learned")), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert sum(w[5] for w in want) > 0


def test_context_finds_unseen_identifiers_and_no_others(spark):
    rows = [(k, f"hello there, my account: user{k}@host.example.org was closed") for k in range(12)]
    rows += [(100, "hello again, my account: QX-48213 was closed"), (101, "order QX-48213 arrived"), (102, "in the year 20192 of"), (103, "invoice 48213-7 of the day")]
    got = {r.doc_id: [s.kind for s in r.found] for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == got[101] == ["learned"] and got[102] == got[103] == [] and got[3] == ["email"]


def test_long_texts_and_empty_tables(spark):
    rows = [(1, "a" * 500_000 + " x@y"), (2, "1" * 200_000), (3, "7 " * 200_000), (4, "+1" + " " * 200_000), (5, "me@a.bc " * 20_000), (6, "1.1.1." * 50_000)]
    got = {r.doc_id: r.found for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert {i: len(f) for i, f in got.items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 20_000, 6: 37_500}
    assert [s.start for s in got[5]][-1] == 8 * 19_999
    assert personal.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0

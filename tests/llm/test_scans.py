"""Decontamination and license scan."""

import random
import re

from loomlake.llm import decontamination, license_scan


def test_leaks_are_exact(spark):
    """Against brute force: items of one word to 20,000, items that share an id, null and empty ones, clashing columns."""
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 60)))) for i in range(25)]
    items += [(40, "who wrote hamlet"), (41, "zebra"), (42, "the answer is forty"), (43, "quick brown"), (3, items[4][1]), (3, items[3][1])]
    items += [(44, " ".join(f"v{i}" for i in range(20_000))), (30, None), (31, ""), (32, "--")]
    docs = []
    for i in range(60):
        words = [word() for _ in range(rng.randint(1, 400))]
        if i % 2:
            part = items[i % 25][1].split()
            if i % 4 == 1 and len(part) > 30:
                part[len(part) // 2] = "other"
            at = rng.randrange(len(words))
            words[at:at] = part
        docs.append((i, " ".join(words).upper() if i % 3 else ", ".join(words)))
    docs += [(100, None), (101, ""), (None, items[3][1] + " " + items[4][1]), (102, "x y " * 20000), (103, "Tell me: who wrote Hamlet?"), (104, "zebra"), (105, "the answer is"), (106, "who wrote. hamlet quick")]
    docs += [(107, "a " + items[31][1].replace("v5 ", "") + " b"), (108, items[31][1][: len(items[31][1]) // 2])]

    def shingles(t, k):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for d, t in docs:
        for i, x in items:
            k = min(5, len(re.findall(r"[^\W_]+", x or "")))
            if k and len((s := shingles(x, k)) & (h := shingles(t, k))) / len(s) >= 0.8:
                want.add((d, i, len(s), len(s & h)))
    assert {(103, 40, 1, 1), (104, 41, 1, 1), (106, 40, 1, 1)} <= want and (107, 44, 19996, 19991) in want
    docs_df = spark.createDataFrame([(d, t, 1, "k") for d, t in docs + docs[:1]], "doc_id long, text string, _row int, leak string")
    items_df = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, value string")
    for limit in (1 << 26, 0):  # broadcast, and the way beyond it
        got = [tuple(r) for r in decontamination.find_leaks(docs_df, items_df, limit).select("doc_id", "item_id", "n_item", "n_shared").collect()]
        assert set(got) == want and len(got) == len(want)
    kept = decontamination.drop_leaks(docs_df, items_df)
    assert kept.columns == docs_df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, *_ in want}
    empty = items_df.filter("item_id < 0")
    assert decontamination.find_leaks(docs_df, empty).count() == 0
    assert decontamination.find_leaks(docs_df.filter("doc_id < 0"), items_df).count() == 0


def test_license_scan(spark):
    mit = next(" ".join(w) for label, w in license_scan.TEMPLATES if label == "mit" and len(w) > 30)
    broken = mit.replace("without restriction", "without any restriction").replace("the software", "The Software,")
    texts = [
        (1, "Some text. Released under the MIT License."), (2, "ALL RIGHTS\nReserved. cc-by, CC BY"), (3, None), (4, ""),
        (5, "é " * 30 + broken + " tail" * 9), (6, "under the mit bridge"), (7, "GNU General Public  License; general public licenses"),
        (8, "cc by cc by"), (9, "Licensed under CC BY-NC 4.0."), (None, "all rights reserved"), (10, "word " * 30000),
    ]
    df = spark.createDataFrame([(d, t, "x") for d, t in texts + [(2, texts[1][1])]], "doc_id long, text string, label string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}
    assert license_scan.scan_licenses(df).count() == len(texts) + 1
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for d, t in texts:
        words = pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = sorted(i for p, _ in license_scan.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        labels = sorted({x for p, x in license_scan.BASE if any(words[i : i + len(p.split())] == p.split() for i in range(len(words)))})
        r = got[d]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(labels)), t
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert set(labels) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert got[1]["labels"] == got[5]["labels"] == "mit" and got[6]["labels"] == ""
    assert got[9]["labels"] == "cc-by,cc-by-nc-4.0"
    spans = license_scan.license_spans(df).filter("doc_id = 5").collect()
    assert (30, 30 + len(broken.split()) - 1) in {(r["first_word"], r["last_word"]) for r in spans}
    assert license_scan.scan_licenses(df.filter("doc_id < 0")).count() == 0


def plain_spans(words):
    """(label, template, first, last, cover) by brute force: hits by diagonal, near diagonals together."""
    out, k = set(), license_scan.K
    for t, (label, template) in enumerate(license_scan.TEMPLATES):
        grams = len(template) - k + 1
        hits = sorted((p - q, p, q) for p in range(len(words) - k + 1) for q in range(grams) if words[p : p + k] == template[q : q + k])
        runs = []
        for d, p, q in hits:
            if not runs or d - runs[-1][-1][0] > min(license_scan.MERGE, grams - 1):
                runs.append([])
            runs[-1].append((d, p, q))
        for run in runs:
            cover = len({q for *_, q in run}) / grams
            if cover >= license_scan.COVER:
                out.add((label, t, min(p for _, p, _ in run), max(p for _, p, _ in run) + k - 1, round(cover, 9)))
    return out


def test_labels_and_score_against_brute_force(spark):
    """Notices with words put in, left out, repeated, overlapping and cut off, between other words."""
    rng = random.Random(8)
    texts = [" ".join(["all rights reserved"] * 4), "licensed under cc by 4 0 " * 3, "licensed under the licensed under the mit license", ""]
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [rng.choice("stone river under the license of".split()) for _ in range(rng.randint(0, 8))]
            part = list(rng.choice(license_scan.TEMPLATES)[1])
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(part))
                part[at : at + rng.randint(0, 2)] = [rng.choice("stone the software".split())] * rng.randint(0, 3)
                part = part or ["stone"]
            words += part[: rng.choice([len(part), len(part), max(1, len(part) * 4 // 5)])]
        texts.append(", ".join(words).title())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans, got = {}, {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}
    for r in license_scan.license_spans(df).collect():
        spans.setdefault(r["doc_id"], []).append((r["label"], r["template"], r["first_word"], r["last_word"], round(r["cover"], 9)))
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower())
        want = plain_spans(words)
        assert sorted(spans.get(i, [])) == sorted(want), t
        base = [x for p, x in license_scan.BASE if any(words[j : j + len(p.split())] == p.split() for j in range(len(words)))]
        assert got[i]["labels"] == ",".join(sorted({*base, *(x[0] for x in want)}))
        assert abs(got[i]["score"] - (1.0 if base else min(1.0, max((x[4] for x in want), default=0.0)))) < 1e-6
    assert sum(s[0] == "reserved" for s in spans[0]) == 4

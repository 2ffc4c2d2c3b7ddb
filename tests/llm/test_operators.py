"""Operators for training text against brute force, on small and awkward inputs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataform.llm import groups, language, mainbody, mixing, packing, pages, repetition, sitelines, splitting, survivors, textstats
from strataform.llm.tokens import token_count, token_spans

AWKWARD = [None, "", " ", " ", "word", "a_b-c d.e", "x" * 5000, "é ü ß 漢字 123", "\x00 nul", "line\r\nline\rline", "\U0001f600 smile", "tab\tand\x0bmore"]


def test_tokens(spark):
    import re

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "doc_id long, text string").select("doc_id", token_count(F.col("text")).alias("n")).collect()
    for r in rows:
        t = AWKWARD[r.doc_id] or ""
        want = [m.span() for m in re.finditer(r"\w+|[^\w\s]+", t)]
        assert r.n == len(want), repr(t)
        assert list(zip(*map(list, token_spans(t)), strict=True)) == want, repr(t)


def brute_repetition(text, size=8):
    import re

    words = re.findall(r"[^\W\d_]+", text.lower())
    seen, covered = set(), set()
    for i in range(len(words) - size + 1):
        gram = tuple(words[i : i + size])
        if gram in seen:
            covered.update(range(i, i + size))
        seen.add(gram)
    longest = 0
    for i in range(len(words)):
        for j in range(i):
            k = 0
            while i + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    return len(words), len(covered), longest


def test_repetition_equals_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "Cd", "ef", "9"]) for _ in range(rng.randint(0, 70))) for _ in range(60)] + ["", "a " * 40, "12 !?", "x\x00y " * 20]
    total, covered, longest, _ = repetition.repetition(texts)
    assert [(int(a), int(b), int(c)) for a, b, c in zip(total, covered, longest, strict=True)] == [brute_repetition(t) for t in texts]


def test_repetition_signals(spark):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "no id"), (100, "one two three four five six seven eight nine " * 3), (100, "again the same id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = repetition.repetition_signals(frame).collect()
    assert len(got) == len(AWKWARD) + 2 and sum(r.repetitive for r in got) == 1
    assert repetition.repetition_signals(frame.limit(0)).count() == 0


def _named(found, texts):
    """The report with the names of sites and lines."""
    spark = found.documents.sparkSession
    rows = {(s, "".join(c for c in x.lower() if c.isalpha())) for s, lines in texts.values() for x in lines}
    names = spark.createDataFrame(sorted(rows), "site string, line string")
    hashed = names.select("site", "line", F.xxhash64("site").alias("s"), F.xxhash64("line").alias("l"))
    return found.report().select(F.col("site").alias("s"), F.col("line").alias("l"), "significant", "frequent").join(hashed, ["s", "l"])


def brute_excess(per, sites, rate=0.05):
    """``(site, line)`` of lines in six documents or more that the ratio test finds, in rounds."""
    everything, found = sum(sites.values()), set()
    tested = [k for k, n in per.items() if n >= 6]
    while True:
        tails = {}
        for s, line in tested:
            others = [x for x in sites if x != s and (x, line) not in found]
            k1, n1, k2, n2 = per[s, line], sites[s], sum(per[x, line] for x in others), sum(sites[x] for x in others)
            assert n2 > 0
            p = (k1 + k2) / (n1 + n2)
            g = 0.0
            if k1 / n1 > k2 / n2:
                for k, n in ((k1, n1), (k2, n2)):
                    g += (2 * k * math.log(k / (n * p)) if k else 0) + (2 * (n - k) * math.log((n - k) / (n * (1 - p))) if n > k else 0)
            tails[s, line] = math.erfc(math.sqrt(g / 2)) if (s, line) not in found else 0.0
        ordered = sorted(tails.values())
        cut = max((t for i, t in enumerate(ordered, 1) if t <= rate * i / len(ordered)), default=-1)
        now = {k for k, t in tails.items() if t <= cut}
        if now == found:
            return found
        found = now


def test_site_lines_equal_brute_force(spark):
    rng = random.Random(2)
    docs, resources = [], []
    for site in range(6):
        for k in range(rng.randint(4, 30)):
            url = f"https://www.s{site}.example/{k}"
            lines = [f"Text of {site} number {chr(97 + k % 26) * 3} {'abcdefgh'[rng.randrange(8)]}" for _ in range(3)]
            if rng.random() < 0.5:
                lines.insert(rng.randrange(3), f"Share  THIS page {k}!" if site % 2 else f"Cookies of {site}")
            docs.append((f"{site}-{k}", url, rng.choice(["\n".join(lines)] * 9 + [None])))
            if rng.random() < 0.7:
                resources.append((url, f" WWW.S{site}.example ", None))
    docs += docs[:5] + [(None, "https://s1.example/x", "Cookies of 1"), ("lonely", None, "Cookies"), ("empty", "https://s1.example/e", "")]
    documents = spark.createDataFrame(docs, "id string, source_url string, normalized_text string").withColumn("site", F.lit(1))
    known = spark.createDataFrame(resources, "url string, domain string, last_seen_at timestamp")
    found = sitelines.SiteLines(documents, known)
    key = lambda line: "".join(c for c in line.lower() if c.isalpha())
    texts = {i: (u.split("/")[2].removeprefix("www."), t.split("\n")) for i, u, t in docs if i and u and t is not None}
    per, sites = Counter(), Counter(s for s, _ in texts.values())
    for s, lines in texts.values():
        per.update({(s, key(x)) for x in lines if key(x)})
    bad = {k for k in brute_excess(per, sites) if per[k] >= 0.1 * sites[k[0]]}
    assert bad == {(r.site, r.line) for r in _named(found, texts).where("significant and frequent").collect()}
    want = {(i, n) for i, (s, lines) in texts.items() for n, x in enumerate(lines, 1) if (s, key(x)) in bad}
    assert want and {(r.id, r.line_no) for r in found.occurrences().collect()} == want
    cleaned = {r.id: r for r in found.cleaned().collect()}
    for i, (_, lines) in texts.items():
        assert cleaned[i].normalized_text == "\n".join(x for n, x in enumerate(lines, 1) if (i, n) not in want)
    assert cleaned["lonely"].normalized_text == "Cookies" and found.cleaned().count() == len(docs)
    assert sitelines.SiteLines(documents.limit(0), known).occurrences().count() == 0


PAGE = """<!doctype html><html><head><title>Head line | Site Name</title><style>p{}</style></head><body>
<nav><li><a href="/">Home</a><li><a href="/a">News</a></nav><div class="bab"><p>We use cookies</div>
<div class="main"><h1>Head line</h1><address>By Someone</address><p>First paragraph of the story, with some words.<p>Subscribe now and read the first month free
<p><a href="/x">See also: another story</a></p><ul><li>one<li>two</ul><p hidden>secret</p><p style="display: none">more</p><table><tr><td>a<td>bb<tr><td>ccc<td>d</table></div>
<section><h3>Comments (3)</h3><p>What a nice and long comment this is, really, isn't it?</section><footer>Site &amp; Name &copy;</footer><script>var x = "<p>no</p>"</script></body></html>"""


def test_page_tree():
    page = pages.parse(PAGE)
    assert [b.text for b in page.blocks][:4] == ["Home", "News", "We use cookies", "Head line"] and page.blocks[-1].text == "Site & Name ©"
    assert not any("secret" in b.text or "more" == b.text or "no" == b.text for b in page.blocks)
    inside = [b.text for b, ok in zip(page.blocks, mainbody.main_blocks(page), strict=True) if ok]
    assert inside[0] == "Head line" and inside[-1] == "d" and "Home" not in inside and not any("comment" in t for t in inside)
    text = pages.render(page)
    assert "- one\n- two" in text and "a    bb\nccc  d" in text
    for broken in ("", "<", "<p", "</p></div>", "<!-- open", "<a href='", "<table><td>x", "plain", "<p>" * 3000 + "deep"):
        pages.render(pages.parse(broken))


def test_main_body(spark):
    lines = [b.text for b in pages.parse(PAGE).blocks]
    # The prompt recurs on other pages, whose own paragraphs differ.
    others = {f"o{i}": PAGE.replace("First paragraph", f"Paragraph {chr(97 + i) * 3}").replace("See also: another story", f"See {i}") for i in range(5)}
    artifacts = spark.createDataFrame([(k, bytearray(x.encode()), None) for k, x in others.items()] + [("p", bytearray(PAGE.encode()), None), ("t", bytearray(b"plain"), None), ("n", None, None), (None, bytearray(b"<p>x"), None)], "artifact_id string, raw_data binary, content_type string")
    results = [(k, "\n".join(b.text for b in pages.parse(x).blocks), None) for k, x in others.items()] + [("p", "\n".join(lines), None)] * 2 + [("t", "plain", None), ("n", None, None), ("gone", "text", None), (None, "x", None)]
    extractions = spark.createDataFrame(results, "artifact_id string, canonical_text string, created_at timestamp")
    found = {(r.artifact_id, r.line_no) for r in mainbody.page_lines(artifacts, extractions).where("outside").collect()}
    kept = [x for i, x in enumerate(lines, 1) if ("p", i) not in found]
    assert kept == ["Head line", "By Someone", "First paragraph of the story, with some words.", "one", "two", "a", "bb", "ccc", "d"]
    bodies = {r.artifact_id: r.main_body for r in mainbody.main_bodies(artifacts, extractions).collect() if r.artifact_id not in others}
    body = "Head line\n\nBy Someone\n\nFirst paragraph of the story, with some words.\n- one\n- two\na    bb\nccc  d"
    assert bodies == {"p": body, "t": "plain", "gone": "text"}
    alone = mainbody.main_bodies(artifacts, spark.createDataFrame([("p", "\n".join([*lines[:7], "No block shows this", *lines[7:]]), None)], "artifact_id string, canonical_text string, created_at timestamp")).first()
    assert alone.main_body.split("\n")[:2] == ["Head line", "By Someone"] and alone.body_lines + alone.furniture_lines == len(lines) + 1
    assert mainbody.page_lines(artifacts.limit(0), extractions).count() == 0


def test_composition(spark):
    from strataform.llm.examples import EXAMPLES

    # Each example stands beside others of its kind, as texts of a collection do.
    rows = [(i, text, kind) for i, (kind, _, text) in enumerate(EXAMPLES)]
    frame = spark.createDataFrame([*rows, (900, None, ""), (901, " ", ""), (None, "x", "")], "doc_id long, text string, kind string")
    got = {r.doc_id: r for r in textstats.composition(frame).collect()}
    assert got[900].kind == got[901].kind == "blank" and len(got) == len(rows) + 2
    assert np.mean([(got[i].prose_share >= 0.5) == (kind == "prose") for i, _, kind in rows]) >= 0.9
    assert textstats.composition(frame.limit(0)).count() == 0


def test_language(spark):
    texts = {
        "en": "The committee said that the members had seen the new timetable, although nobody was sure about the price. The report was published after a long discussion.",
        "es": "El comité dijo que los socios habían visto el nuevo calendario, aunque nadie estaba seguro del precio. El informe se publicó después de una larga discusión.",
        "fr": "Le comité a dit que les membres avaient vu le nouveau calendrier, mais personne n'était sûr du prix. Le rapport a été publié après une longue discussion.",
        "de": "Der Ausschuss sagte, die Mitglieder hätten den neuen Zeitplan gesehen, aber niemand war sich über den Preis sicher. Der Bericht wurde nach einer langen Aussprache veröffentlicht.",
    }
    rows = [(i, t, "xx") for i, t in enumerate(texts.values())] + [(10, " ".join(texts[k] for k in ("en", "de")), "en"), (11, "0x00 12 34 !!", None), (12, None, None), (13, texts["en"], " English "), (14, texts["de"], "en-GB")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    detected = language.detect_language(frame)
    cases = {(r.doc_id, r.lang) for r in language.label_cases(detected).collect()}
    assert cases == {(0, "en"), (1, "es"), (2, "fr"), (3, "de"), (10, "en"), (10, "de"), (14, "de")}
    assert [r.language for r in language.language_segments(frame.where("doc_id = 10")).orderBy("segment_no").collect()] == ["en", "de"]
    assert language.label_code("pt_BR") == "pt" and language.label_code("deu") == "de" and language.label_code("und") is None
    assert detected.limit(0).count() == 0


def test_language_gradients():
    from strataform.llm import train_language as train

    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in train.initial(rng).items()}
    symbols, size = rng.integers(0, 256, (7, 5)), np.array([7, 3, 5, 7, 1])
    for k, n in enumerate(size):
        symbols[n:, k] = language.PAD
    target = np.array([0, 1, 2, 7, 3])
    _, grad = train.gradients(w, symbols, target, size)
    for name in ("out_w", "forward_u", "backward_w", "embedding", "forward_b"):
        at = tuple(rng.integers(0, s) for s in w[name].shape) if name != "embedding" else (int(symbols[0, 0]), 3)
        step = 1e-5
        w[name][at] += step
        up, _ = train.gradients(w, symbols, target, size)
        w[name][at] -= 2 * step
        down, _ = train.gradients(w, symbols, target, size)
        w[name][at] += step
        assert grad[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_groups_equal_union_find(spark):
    rng = random.Random(4)
    pairs = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}", rng.random() < 0.5) for _ in range(70)]
    pairs += [(f"c{i:03d}", f"c{i + 1:03d}", True) for i in range(120)] + [("hub", f"h{i}", True) for i in range(50)]
    pairs += [(" C000 ", "C119", False), (None, "x", True), ("x", None, True), ("y", "y", True), ("y", "Y ", True), ("z", "q", None), ("", "q", True)]
    frame = spark.createDataFrame(pairs, "document_a_id string, document_b_id string, is_duplicate boolean").withColumn("label", F.lit(1))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b, same in pairs:
        a, b = (a or "").strip().lower(), (b or "").strip().lower()
        if a and b and a != b and same:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert {(r.group_id, r.document_id) for r in groups.consolidate(frame).collect()} == {(find(x), x) for x in parent}
    assert groups.consolidate(frame.limit(0)).count() == 0


DOCUMENT = "document_id string, normalized_text string, quality_score double, warning_count long, source_url string, raw_checksum string, canonical_checksum string, canonical_document_id string, normalized_document_id string, artifact_id string, updated_at timestamp"
MEMBER = "group_id string, normalized_document_id string, canonical_document_id string, artifact_id string"


def test_survivors(spark):
    from datetime import datetime as at

    nan = float("nan")
    rows = [
        ("a", "text", nan, 0, None, "ra", None, None, "a", "x1", at(2030, 1, 2)),
        ("a", None, 0.9, 0, "old", "ro", "co", None, "a", "x1", at(2030, 1, 1)),
        ("b", "text", 0.5, None, None, None, "cb", "kb", "b", "x2", at(2030, 1, 1)),
        ("b", "text", 0.5, None, None, None, "cb", "kb", "b", "x2", at(2030, 1, 1)),
        ("c", "", 1.0, 0, "uc", "rc", "cc", "kc", "c", "x3", at(2030, 1, 1)),
        ("d", "text", 0.5, 2, "ud", None, None, None, "d", "x4", at(2030, 1, 1)),
        (None, "text", 1.0, 0, "u", "r", "c", "k", "n", "x5", at(2030, 1, 1)),
    ]
    members = [("g", "a", None, None), ("g", None, "kb", None), ("g", "c", None, None), ("g", None, None, "x4"), ("g", "a", None, None), ("g", "gone", None, None), (None, "a", None, None), ("g2", None, None, None), ("g3", "c", None, None)]
    got = {(r.group_id, r.field_name): r.document_id for r in survivors.survivors(spark.createDataFrame(rows, DOCUMENT), spark.createDataFrame(members, MEMBER)).collect()}
    assert got == {
        ("g", "document_id"): "d", ("g", "source_url"): "d", ("g", "raw_checksum"): "a", ("g", "canonical_checksum"): "b", ("g", "canonical_document_id"): "b",
        ("g3", "document_id"): "c", ("g3", "source_url"): "c", ("g3", "raw_checksum"): "c", ("g3", "canonical_checksum"): "c", ("g3", "canonical_document_id"): "c",
    }
    built = survivors.surviving_records(spark.createDataFrame(rows, DOCUMENT), spark.createDataFrame(members, MEMBER)).where("group_id = 'g'").first()
    assert (built.document_id, built.source_url, built.raw_checksum, built.canonical_checksum) == ("d", "ud", "ra", "cb")


def test_currency_without_timestamps(spark):
    from datetime import datetime as at

    # Warnings only ever grow in the dated rows, so of undated rows the one with most is the latest.
    dated = [(f"d{i}", "t", 0.5, k, "u", "r", "c", "k", f"d{i}", None, at(2030, 1, 1 + k)) for i in range(20) for k in range(4)]
    undated = [("q", "t", 0.5, k, f"u{k}", "r", "c", "k", "q", None, None) for k in (0, 3, 1)]
    rows = survivors.document_rows(spark.createDataFrame(dated + undated, DOCUMENT), keep=("source_url",))
    assert survivors.current_rows(rows).where("document_id = 'q'").first().value_source_url == "u3"
    assert survivors.current_rows(rows.where("document_id = 'q'")).count() == 1 and survivors.current_rows(rows.limit(0)).count() == 0


def test_topological_levels():
    levels, weight = survivors.topological_levels([(1, 2, 20), (2, 3, 20), (1, 3, 9), (3, 1, 1)])
    assert levels == {1: 0.0, 2: 0.5, 3: 1.0} and 0.9 < weight < 1
    # 5, 6 and 7 lie on a cycle and share a level between what comes before and after; 9 is not proven.
    levels, _ = survivors.topological_levels([(4, 5, 9), (5, 6, 9), (6, 7, 9), (7, 5, 9), (6, 8, 9), (8, 9, 5), (9, 8, 4)])
    assert levels == {4: 0.0, 5: 0.5, 6: 0.5, 7: 0.5, 8: 1.0, 9: 0.0}
    assert survivors.topological_levels([]) == ({}, 0.0)


def test_currency_of_equal_dates(spark):
    from datetime import datetime as at

    # Scores rise in the dated rows; two rows of one date are told apart by that, not by the order of their values.
    dated = [(f"d{i}", "t", 0.9 - 0.3 * k, 1, "u", "r", "c", "k", f"d{i}", None, at(2030, 1, 1 + k)) for i in range(20) for k in range(3)]
    ties = [("q", "t", x, 1, f"u{x}", "r", "c", "k", "q", None, at(2030, 5, 1)) for x in (0.9, 0.3, 0.6)]
    frame = spark.createDataFrame(dated + ties, DOCUMENT)
    rows = survivors.document_rows(frame, keep=("source_url",))
    assert survivors.current_rows(rows).where("document_id = 'q'").first().value_source_url == "u0.3"
    trial = survivors.currency_trial(frame.where("document_id <> 'q'"), parts=2).first()
    assert trial.documents > 3 and trial.right == trial.documents and abs(trial.chance - 1 / 3) < 0.02


def test_packing(spark):
    rng = random.Random(5)
    items = [(i, rng.choice([0, 1, 3, 7, 10, 11, 25, 30])) for i in range(300)] + [(1, 4), (1, 4)]
    frame = spark.createDataFrame(items, "doc_id long, n_tokens long").withColumn("shard", F.lit("clash"))
    got = packing.pack(frame, [("ten", 10), ("one", 1)], open_containers=4, shard_items=100).collect()
    for name, capacity in (("ten", 10), ("one", 1)):
        rows = [r for r in got if r.spec_name == name]
        used = Counter()
        for r in rows:
            used[r.container_id] += r.n_tokens
            assert (r.container_id is None) == (r.n_tokens == 0)
        assert max(v for k, v in used.items() if k is not None) <= capacity
        assert sum(r.n_tokens for r in rows) == sum(n for _, n in items)
        cut = {r.doc_id for r in rows if r.piece_no > 0}
        assert cut == {i for i, n in items if n > capacity}
    assert packing.pack(frame.limit(0), [("ten", 10)]).count() == 0
    shelf = packing.Shelf(10, 2, 0)
    assert [shelf.place(n) for n in (6, 5, 4, 7, 3, 5)] == [0, 1, 0, 2, 2, 1]


@pytest.mark.parametrize(("shard_tokens", "block_tokens"), [(500, 60), (3, 1), (10**6, 10**5)])
def test_mixing(spark, shard_tokens, block_tokens):
    rng = random.Random(6)
    documents = [(i, rng.choice(["A", " a ", "b", "c", None]), " ".join(["w"] * rng.randint(1, 40))) for i in range(600)] + [(7, "b", None), (8, "b", ""), (None, "b", "no id"), (None, "b", "no id")]
    targets = [("m", "a", 3.0, 1, 0.3), ("m", "B", 1.0, 9, 0.3), ("m", "ghost", 1.0, 2, 0.3), ("m", None, 1.0, 1, 0.3), ("big", "c", 1.0, 2, 0.9), ("zero", "a", 0.0, 1, 0.5), ("never", "b", 1.0, 0, 0.1)]
    mixture = mixing.Mixture(spark.createDataFrame(documents, "doc_id long, source string, text string"), spark.createDataFrame(targets, "mix_name string, source string, target_share double, max_repeats int, budget_fraction double"), shard_tokens=shard_tokens, block_tokens=block_tokens)
    total = sum(len((t or "").split()) for *_, t in documents)
    tokens = Counter()
    for _, s, t in documents:
        tokens[(s or "").strip().lower()] += len((t or "").split())
    drawn = mixture.drawn().collect()
    shares = {(r.mix_name, r.source): r for r in mixture.shares().collect()}
    assert set(shares) == {("m", "a"), ("m", "b"), ("m", "ghost"), ("big", "c"), ("never", "b")}
    assert {k for k, r in shares.items() if r.short} == {("m", "ghost"), ("never", "b")} | ({("big", "c")} if tokens["c"] * 2 < 0.9 * total else set()) | ({("m", "a")} if tokens["a"] < 0.6 * 0.3 * total else set())
    for (mix, source), r in shares.items():
        mine = [x for x in drawn if (x.mix_name, x.source) == (mix, source)]
        assert sum(x.n_tokens for x in mine) == r.drawn_tokens and r.available_tokens == tokens[source]
        assert max(Counter((x.doc_id, x.repeat_no) for x in mine if x.doc_id is not None).values(), default=0) <= 1 and all(x.repeat_no < r.max_repeats for x in mine)
        if not r.short:
            assert abs(r.drawn_tokens - r.target_tokens) <= 40
    places = Counter((x.mix_name, x.shard) for x in drawn)
    assert all(sorted(x.position for x in drawn if (x.mix_name, x.shard) == k) == list(range(1, n + 1)) for k, n in places.items())
    # Every shard gets its exact number of block copies, and no copy is drawn twice.
    copies = mixture.draws().collect()
    assert len({(c.target, c.block, c.repeat_no) for c in copies}) == len(copies)
    for mix, shards in mixture.shards.items():
        mine = [i for i, q in enumerate(mixture.quotas) if q.mix == mix]
        most = sum(mixture.quotas[i].copies for i in mine) / shards
        got = Counter(c.shard for c in copies if c.target in mine)
        assert all(0 <= k < shards and n <= most + 1 for k, n in got.items())
    empty = mixing.Mixture(spark.createDataFrame([], "doc_id long, source string, text string"), spark.createDataFrame(targets, "mix_name string, source string, target_share double, max_repeats int, budget_fraction double"))
    assert empty.drawn().count() == 0 and empty.shares().where("short").count() == 0


def test_shares_come_from_the_draw(spark):
    documents = spark.createDataFrame([(i, "a" if i % 3 else "b", "one two three") for i in range(90)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("m", "a", 1.0, 1, 0.9), ("m", "b", 1.0, 1, 0.9)], "mix_name string, source string, target_share double, max_repeats int, budget_fraction double")
    mixture = mixing.Mixture(documents, targets)
    assert [r.source for r in mixing.short_sources(mixture.shares()).collect()] == ["b"]
    mixture.draws = lambda: mixing.Mixture.draws(mixture).limit(0)
    assert mixing.short_sources(mixture.shares()).count() == 0


def test_split_tree():
    rng = np.random.default_rng(0)
    for shards, quotas in ((1, [5, 0, 17, 40]), (3, [5, 0, 17, 40]), (7, [5, 0, 17, 40]), (1000, [20000, 1, 0, 3210])):
        source = np.repeat(np.arange(4), quotas)
        rank = np.concatenate([np.arange(q) for q in quotas])
        shard = mixing.shards_of(source, rank, quotas, shards, 5)
        assert np.ptp(np.bincount(shard, minlength=shards)) <= 1 and shard.max() < shards
        # Disjoint runs of ranks, and the same answer for a part of the copies.
        assert all((np.diff(shard[source == s]) >= 0).all() for s in range(4))
        some = rng.permutation(source.size)[: source.size // 2]
        assert np.array_equal(mixing.shards_of(source[some], rank[some], quotas, shards, 5), shard[some])
    # A shard's part of a source follows the hypergeometric law in the mean.
    halves = [np.count_nonzero(mixing.shards_of(np.repeat([0, 1], [30, 10]), np.r_[0:30, 0:10], [30, 10], 2, key)[30:] == 0) for key in range(300)]
    assert abs(np.mean(halves) - 5) < 0.4 and np.std(halves) > 0.8


def test_keyed_permutation():
    for size in (1, 2, 3, 5, 64, 65, 1000):
        out = mixing.permuted(np.arange(size), size, 3)
        assert sorted(out.tolist()) == list(range(size))
    assert not np.array_equal(mixing.permuted(np.arange(1000), 1000, 1), mixing.permuted(np.arange(1000), 1000, 2))


@pytest.mark.parametrize(("most", "overlap"), [(8, 0), (8, 3), (5, 4), (1, 0), (30, 10)])
def test_splitting(spark, most, overlap):
    rng = random.Random(most)
    texts = [" ".join(rng.choice(["word", "end.", "x-y,z", "\n\n", "# head", "(a)", "\n- item"]) for _ in range(rng.randint(0, 90))) for _ in range(25)] + AWKWARD + ["a" * 9000, "é." * 400]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = splitting.split_documents(frame, [("s", most, overlap)]).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        starts, ends = token_spans(t or "")
        assert (i in by) == (starts.size > most)
        at = 0
        for k, r in enumerate(sorted(by.get(i, []), key=lambda r: r.piece_no)):
            assert r.n_tokens <= most and r.overlap_tokens == (min(overlap, most - 1) if k else 0) and r.token_start == at - r.overlap_tokens
            assert r.text == t[starts[r.token_start] : ends[r.token_end - 1]]
            at = r.token_end
        assert i not in by or at == starts.size


def test_splitting_prefers_natural_boundaries():
    text = "# One\n\nFirst sentence here. Second one follows now.\n\nA paragraph of its own stands here.\n\n# Two\n\nLast words."
    starts, ends = token_spans(text)
    levels = splitting.boundary_levels(text, starts, ends)
    pieces = [text[starts[a] : ends[b - 1]] for a, _, b in splitting.cut(levels, 12, 0)]
    assert pieces[0].endswith("follows now.") and pieces[-1].startswith("# Two")


def test_language_of_a_short_passage_in_a_long_text(spark):
    french = "Le comité a dit que les membres avaient vu le nouveau calendrier, mais personne n'était sûr du prix. Le rapport a été publié après une longue discussion."
    english = [f"The {who} said that the {what} had been seen by all the members before the meeting." for who in ("chairman", "teacher", "farmer", "reader", "doctor") for what in ("timetable", "letter", "price list", "report", "house", "garden", "map", "book")]
    half = len(english) // 2
    apart = french.split(". ")
    rows = [(0, " ".join([*english, french]), "en"), (1, " ".join([*english[:half], apart[0] + ".", *english[half:], apart[1]]), "en"), (2, " ".join(english), "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang) for r in language.label_cases(language.detect_language(frame)).collect()} == {(0, "en"), (0, "fr"), (1, "en"), (1, "fr")}


def test_language_mistaken_sentences():
    # Two sentences taken for Dutch have the words of the German ones around them; a Dutch one has its own.
    text = "Am Ende lieferte der Ausschuss den Bericht. Der Ausschuss archivierte den Bericht am Ende. Am Ende archivierte der Ausschuss den Bericht. Uiteindelijk leverde de commissie het verslag."
    de, nl = language.LANGUAGES.index("de"), language.LANGUAGES.index("nl")
    assert language._mistaken(text, np.array([de, de, nl, nl]), np.ones(4, bool), de) == [2]


def test_words_of_a_capital_i_with_dot():
    # No lower case adds or takes a word, whatever the letters.
    every = " ".join(chr(c) for c in range(0x110000) if chr(c).isalpha())
    assert repetition.word_numbers([every])[0].size == every.count(" ") + 1
    words, text = repetition.word_numbers(["İstanbul", "istanbul"])
    assert words.size == 2 and words[0] == words[1] and text.tolist() == [0, 1]
    plain = "The report was read by all of the members and it was good."
    alone, beside = textstats.segments([plain]), textstats.segments([plain, "A letter came from İzmir to the office and was read."])
    assert alone["linking"][0] > 0 and np.array_equal(alone["features"][0], beside["features"][0]) and beside["linking"][1] > 0


def test_site_lines_beside_a_large_site(spark):
    # One line stands in a tenth of the small site and in just under a tenth of the
    # large one: no excess, whatever its frequency.  The other is the small site's own.
    own = lambda i, least, other: "Read this too" if i < least else other
    rows = [(f"s{i}", "https://small.example/", own(i, 7, "Ours" if i < 14 else f"Own {chr(97 + i % 26) * (1 + i // 26)}")) for i in range(70)]
    rows += [(f"l{i}", "https://large.example/", own(i, 99, f"Text {chr(97 + i % 26) * (1 + i // 26)}")) for i in range(1000)]
    documents = spark.createDataFrame(rows, "id string, source_url string, normalized_text string")
    known = spark.createDataFrame([], "url string, domain string, last_seen_at timestamp")
    found = sitelines.SiteLines(documents, known)
    assert {r.id for r in found.occurrences().collect()} == {f"s{i}" for i in range(7, 14)}
    rejected = [r for r in found.report().collect() if r.frequent and not r.significant]
    assert [(r.n, r.site_docs, r.outside_n, r.outside_docs) for r in rejected] == [(7, 70, 99, 1000)] and rejected[0].ratio < 0.1
    lone = sitelines.SiteLines(documents.where("id like 's%'"), known)
    assert {r.id for r in lone.occurrences().collect()} == {f"s{i}" for i in range(14)}


def test_site_lines_that_mask_each_other(spark):
    # Three sites out of five share a prompt; the smallest shows an excess once the others have left its outside.
    share = {"a": (400, 390), "b": (400, 390), "c": (30, 11), "d": (300, 0), "e": (300, 0)}
    rows = [(f"{s}{i}", f"https://{s}.example/", "Share this" if i < k else f"{s} {chr(97 + i % 26) * (1 + i // 26)}") for s, (n, k) in share.items() for i in range(n)]
    documents = spark.createDataFrame(rows, "id string, source_url string, normalized_text string")
    found = sitelines.SiteLines(documents, spark.createDataFrame([], "url string, domain string, last_seen_at timestamp"))
    assert Counter(r.id[0] for r in found.occurrences().collect()) == {"a": 390, "b": 390, "c": 11}


def test_page_with_a_long_head():
    filler = "<style>" + ".a{margin:1px}\n" * 2000 + "</style>"
    page = f'<html><head>{filler}<meta charset="iso-8859-2"><title>Head line | Site Name</title></head><body><h1>Head line</h1><p>Zażółć, says Site Name.</p></body></html>'
    assert pages.parse(page).title == "Head line | Site Name"
    assert pages.parse(pages.decode(page.encode("iso-8859-2"), None)).blocks[1].text == "Zażółć, says Site Name."
    other = page.replace("Site Name", "Another Place")
    prompts = [mainbody._describe(p.encode("iso-8859-2"), None)[2][1] for p in (page, other)]
    assert prompts[0] == prompts[1] != 0


def test_prompts_of_one_site(spark, monkeypatch):
    # As in a corpus so large that no site's own prompt recurs on a share of it.
    monkeypatch.setattr(mainbody, "PROMPT_SHARE", 1.0)
    own = "Our evening edition comes to your door for a small sum"
    lines = {f"{site}{i}": ["Head line", f"Paragraph {chr(97 + i) * 3} of a story that goes on for a number of words.", own if site == "a" and i < 5 else f"The end of {chr(97 + i) * 3}"] for site in "ab" for i in range(20)}
    page = lambda x: f"<html><body><div><h1>{x[0]}</h1><p>{x[1]}</p><p>{x[2]}</p></div></body></html>"
    artifacts = spark.createDataFrame([(k, f"https://www.{k[0]}.example/{k}", bytearray(page(x).encode()), None) for k, x in lines.items()], "artifact_id string, url string, raw_data binary, content_type string")
    extractions = spark.createDataFrame([(k, "\n".join(x), None) for k, x in lines.items()], "artifact_id string, canonical_text string, created_at timestamp")
    found = mainbody.page_lines(artifacts, extractions)
    assert found.count() == 120 and {(r.artifact_id, r.line_no) for r in found.where("outside").collect()} == {(f"a{i}", 3) for i in range(5)}


def test_sentences_behind_closing_marks():
    text = "“He said: «The price is known to all.»” Another one follows right here.”’)] And this is the third one!! and here stands the last one."
    assert [p[:8] for p, whole in language.sentences(text) if whole] == ["“He said", "Another ", "And this", "and here"]
    assert len(language.sentences("He read (“see it now.”) and went on. Then he left.")) == 2

"""Decontamination, toxicity, HTML, WARC, chat windows and neighbours against direct computations."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidebars.llm import ann, chat_windows, decontamination, toxicity, warc
from tidebars.llm.ann import nearest_neighbours
from tidebars.llm.chat_windows import escape, format_windows, read_back, read_turns, unescape
from tidebars.llm.decontamination import leaked_items, without_leaks
from tidebars.llm.html_text import extract_text, main_text
from tidebars.llm.toxicity import nnpu_weights, score_toxicity, without_toxic
from tidebars.llm.warc import parse, read_warc, record, write_warc

ITEM = "Alice buys 12 apples for 3 dollars each and gives 5 of them to her friend Bob. How many apples are left over?"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def leaks(spark, docs, rows, items):
    return sorted((r["id"], r["item_id"], r["exact"]) for r in leaked_items(docs(rows), bench(spark, items)).collect())


def test_planted_questions(spark, docs):
    other = "Carol buys 40 apples for 7 dollars each and gives 9 of them to her friend Dave. How many apples are left over?"
    mixed_up = "Carol buys 40 apples for 7 dollars each and gives 9 of them to her friend Dave. " * 2
    rows = [
        (1, f"noise before {ITEM} noise after"), (2, ITEM.upper()), (3, "  \n".join(ITEM.split())), (4, other),
        (5, "a clean text about 12 apples and 3 pears that someone gives to a friend"), (6, ""), (7, None),
        (8, ITEM.lower().replace("?", "").replace(".", "")), (9, mixed_up)]
    got = leaks(spark, docs, rows, [(100, ITEM), (101, None), (102, "")])
    assert got == [(1, 100, True), (2, 100, True), (3, 100, True), (4, 100, False), (8, 100, True), (9, 100, False)]


def test_inconsistent_slots_are_no_leak(spark, docs):
    item = "take 4 red balls then put 4 red balls back in the box"
    rows = [(1, "take 9 red balls then put 9 red balls back in the box"), (2, "take 9 red balls then put 6 red balls back in the box")]
    # Windows that hold one slot alone still match in the second text; all of them lie on one line, whose slots disagree.
    assert leaks(spark, docs, rows, [(1, item)]) == [(1, 1, False)]


def test_contradictions_leave_the_rest_of_a_line(spark, docs):
    plain = "the quick miller of the village carries heavy sacks up along narrow winding stairs every cold morning"
    edited = f"there are 2 mills by the river and 2 more upstream {plain}"
    swapped = "a farmer sells 12 apples for 3 coins and then buys some fresh bread"
    named = "yesterday John Smith walked along the old harbour wall until John found his brown dog there again"
    rows = [
        (1, edited.replace("2 more", "5 more")),  # one of two equal numbers edited, the rest verbatim
        (2, swapped.replace("12", "7").replace("3", "7")),  # new numbers happen to coincide
        (3, named.replace("John Smith", "Mary").replace("John", "Mary")),
        (4, "there are 7 mills by the river and 9 more upstream with nothing else")]
    assert leaks(spark, docs, rows, [(1, edited), (2, swapped), (3, named)]) == [(1, 1, False), (2, 2, False), (3, 3, False)]


def test_copies_with_few_words(spark, docs):
    items = [(1, "Compute 12 + 45 * 3 - 7 / 2 + 9"), (2, "What is 12 + 35?"), (3, " ".join(str(k * k) for k in range(40))), (4, "7 km, 9 km or 11 km")]
    rows = [(i, f"some words first, {t} and some after") for i, t in items] + [
        (5, "Compute 12 + 45 * 3 - 8 / 2 + 9"), (6, "What is 12 + 36?"), (7, "numbers: " + " ".join(str(k * k) for k in range(20, 30))),
        (8, "numbers: " + " ".join(str(k * k + 1) for k in range(40)))]
    assert leaks(spark, docs, rows, items) == [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (7, 3, True)]


def test_a_phrase_with_other_values_is_no_leak(spark, docs):
    item = "On March 3 2019 the city of Paris opened a museum whose lower floors tell how bread was baked"
    rows = [(1, "On June 5 2020 the city of London was quiet"), (2, item.replace("March 3 2019", "June 5 2020").replace("Paris", "London")), (3, item)]
    assert leaks(spark, docs, rows, [(1, item)]) == [(2, 1, True), (3, 1, True)]


def test_runs_of_a_line():
    def run(values, need):  # values of one slot in each of the windows, of 8 tokens
        return decontamination._run([(k, [("2", v)] if v else []) for k, v in enumerate(values)], 8, need)

    assert run(["3"] * 4 + ["4"] * 9, 16) == (9, 16, False) and run(["3"] * 4 + ["4"] * 8, 16) is None
    assert run(["4"] * 9 + ["3"] * 4, 16) == (9, 16, False) and run(["3"] * 3, 10) == (3, 10, False) and run(["3"] * 3, 16) is None
    assert run(["3", "2", "4", None], 16) == (2, 10, False) and run(["2", None], 16) == (2, 9, True)
    assert decontamination._run([(0, [("1", "2"), ("1", "3")])], 8, 8) is None


def test_matches_brute_force_on_plain_text(spark, docs):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("ako", "eri", "ulo", "ina")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 30)))) for i in range(30)]
    rows = []
    for i in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.5:
            part = rng.choice(items)[1].split()
            a = rng.randint(0, len(part) - 1)
            w[5:5] = part[a:a + rng.randint(1, 20)]
        rows.append((i, " ".join(w)))
    want = set()
    for key, text in rows:
        w = text.split()
        for item, line in items:
            own = line.split()
            n = min(8, len(own))
            grams = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)}
            if any(tuple(w[k:k + n]) in grams for k in range(len(w) - n + 1)):
                want.add((key, item, True))
    assert leaks(spark, docs, rows, items) == sorted(want) and want


def test_decontaminated_rows(spark, docs):
    frame = docs([(1, ITEM), (1, ITEM), (None, "x " + ITEM), (2, "clean text"), (None, None)])
    kept = without_leaks(frame, bench(spark, [(1, ITEM)]))
    assert kept.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == [(2, "clean text"), (None, None)]
    assert without_leaks(frame, bench(spark, [])).count() == 5
    assert leaked_items(docs([]), bench(spark, [(1, ITEM)])).collect() == []


def toxic_corpus(n, seed=3):
    rng = random.Random(seed)
    common, bad = [f"word{chr(97 + i % 26)}{i}" for i in range(300)], ["vilest", "filthier", "scummy", "lowlife"]
    rows, marks = [], []
    for i in range(n):
        w = [rng.choice(common) for _ in range(rng.randint(1, 200))]
        toxic = int(rng.random() < 0.15)
        for _ in range(3 * toxic):
            w.insert(rng.randint(0, len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        marks.append((i, toxic))
    return rows, marks


def test_held_out_accuracy(spark, docs):
    rows, marks = toxic_corpus(1500)
    labels = spark.createDataFrame(marks + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    out = score_toxicity(docs(rows + [(9_000, ""), (9_001, None), (None, "vilest lowlife"), (9_002, "worda0 " * 20_000)]), labels).collect()
    got = {r["id"]: r for r in out}
    assert len(out) == 1504 and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        key = "" if r["id"] is None else str(r["id"])
        assert r["held_out"] == (zlib.crc32(key.encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7)
    held = [(got[i]["predicted"], y) for i, y in marks if got[i]["held_out"]]
    assert np.mean([p == 1 for p, y in held if y]) > 0.95 and np.mean([p == 1 for p, y in held if not y]) < 0.02
    assert got[9_000]["score"] == got[9_001]["score"] < 0.7 and got[None]["score"] > 0.7


def test_held_out_labels_are_not_used(spark, docs):
    rows, marks = toxic_corpus(300)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in marks]
    a, b = (sorted((r["id"], r["score"]) for r in score_toxicity(docs(rows), spark.createDataFrame(m, "doc_id bigint, toxic int")).collect())
            for m in (marks, turned))
    assert a == b


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    frame = docs([(1, "a"), (2, None)])
    assert [r["predicted"] for r in score_toxicity(frame, none).collect()] == [0, 0]
    assert without_toxic(frame, none).columns == frame.columns
    assert score_toxicity(docs([]), spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")).collect() == []


def test_risk_stays_above_zero(monkeypatch):
    """Positives hidden among the unlabelled rows keep high scores; a plain positive-against-rest fit would lose them."""
    monkeypatch.setattr(toxicity, "ROUNDS", 600)
    rng = np.random.default_rng(0)
    truth = np.concatenate([np.ones(200, bool), rng.random(1000) < 0.4])
    x = np.column_stack([truth & (rng.random(1200) < 0.95), rng.random(1200) < 0.5])
    positive = np.arange(1200) < 200
    row, feature = np.nonzero(x)
    w, bias = nnpu_weights(positive, row, feature, 2, 0.4)
    score = 1 / (1 + np.exp(-(x @ w + bias)))
    assert score[200:][truth[200:] & x[200:, 0]].min() > 0.7 and score[200:][~truth[200:]].max() < 0.5


PAGE = (
    '<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head><body>'
    '<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use cookies</div>'
    '<aside><p>Side text that is rather long and would weigh a lot in any window of lines that were summed up here</p></aside>'
    'BODY<section id="comments"><p>Great post, thanks a lot for writing this up, I have learnt much from it and will return</p></section>'
    '<footer>&copy; nobody</footer></body></html>')


@pytest.mark.parametrize("body, text", [
    ("<article><h1>Head</h1><p>One&nbsp;two\n three</p><p>x &lt;b&gt; <b>b</b>old</p></article>", "Head One two three x <b> bold"),
    ("<article><header><h1>In</h1></header><p>a</p><div class='ad'>buy</div><!-- <p>no</p> --><p>z<br>y</p><form>f</form></article>", "In a z y"),
    ("<main><p><a href='x>y'>all link</a></p><button>b</button><p>5 < 6 &amp 7</p></main>", "all link 5 < 6 & 7"),
    ("<div><h1>Kept title</h1><p>" + "long words here " * 12 + "</p><p>short</p></div>", "Kept title " + "long words here " * 12 + "short"),
    ("<article><div class=share>s<div>t</div>u</div><p>v</article>", "v"),
    ("", ""),
])
def test_main_text(body, text):
    assert main_text(PAGE.replace("BODY", body)) == text


BODY_TEXT = "<p>" + "plain words of the story " * 8 + "</p>"


@pytest.mark.parametrize("start, end", [
    ('<div class="content-sidebar-wrap">', "</div>"), ('<div class="has-sidebar">', "</div>"), ('<div class="overflow-hidden">', "</div>"),
    ('<div class="sidebar-wrap">', "</div>"), ('<form id="search">', "</form>"), ('<div title="the hidden cost">', "</div>")])
@pytest.mark.parametrize("element", ["main", "article", "div"])
def test_wrappers_are_kept(start, end, element):
    page = f"<body><nav><a href=/>x</a></nav>{start}<{element}>{BODY_TEXT}</{element}>{end}<div class=share-buttons>Share</div></body>"
    assert main_text(page) == " ".join(BODY_TEXT[3:-4].split())


def test_sections_of_an_article_are_kept():
    inner = ('<section id="discussion"><h2 id="search">Search</h2><p>a</p></section><div class="related-work">b</div><p aria-label="Share of votes">c</p>'
             '<p title="the hidden cost">d <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding="TeX">x=2</annotation></math> e</p>')
    gone = '<p hidden>f</p><p aria-hidden="true">g</p><p style="display: none">h</p><div class="related-posts">i</div><div class="comments">j</div>'
    assert main_text(f"<article>{inner}{gone}</article>") == "Search a b c d x=2 e"
    cards = "<article class=comment-body><p>Nice read</p></article>" * 3
    assert main_text(f"<article>{BODY_TEXT}</article><div id=comments>{cards}</div>") == " ".join(BODY_TEXT[3:-4].split())


@pytest.mark.parametrize("lines", [["Who is there?", "It is I.", "Come in, then.", "Thank you."] * 5, ["春は曙がよい。", "夏は夜がよい。", "秋は夕暮れ。"] * 4, ["Short page."]])
@pytest.mark.parametrize("start, end", [("<p>", "</p>"), ("<div><div><p>", "</p></div></div>")])
def test_short_paragraphs(lines, start, end):
    menu = "".join(f"<li><a href=/{k}>Menu entry number {k}</a></li>" for k in range(30))
    page = f"<body><div><ul>{menu}</ul></div><div>{''.join(start + x + end for x in lines)}</div><div><ul>{menu}</ul></div></body>"
    assert [main_text(page.replace("<ul>", "<nav>").replace("</ul>", "</nav>"))] == [" ".join(lines)]
    assert " ".join(lines) in main_text(page) or len(lines) == 1


def test_links_alone_are_no_text():
    assert main_text("".join(f"<li><a href=/{k}>Menu entry number {k}</a></li>" for k in range(30)) + "<p>(c) us</p>" + "<li><a href=/>Imprint and more</a></li>" * 3) == ""


def test_a_card_is_not_the_article():
    text = " ".join(BODY_TEXT[3:-4].split())
    assert text in main_text(f"<body><div>{BODY_TEXT * 5}</div><div><article><p>Read this as well</p></article></div></body>")
    assert main_text(f"<article>{BODY_TEXT * 5}</article><p>{'words beside it ' * 10}</p>") == " ".join([text] * 5)


def test_broken_pages():
    assert main_text("<article><p>one<p>two<script>never closed <p>x") == "one two"
    assert main_text("<div class=ad>open <article><p>kept") == "kept"
    assert main_text("<article><p>cut &am") == "cut &am" and main_text("<article><p>cut <a hre") == "cut"
    assert main_text("<article><p>a<!-- open") == "a" and main_text("") == main_text(None) == ""
    assert main_text("<article>" + "<p>x</p>" * 30_000) == " ".join("x" * 30_000)


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article>é 🙂</article>", "e"), (1, "u", "<article>é 🙂</article>", "e"), (None, None, None, "e")],
                                  "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, extract_text(pages).collect()), key=str) == [(1, "u", "é 🙂", 3), (1, "u", "é 🙂", 3), (None, None, "", 0)]
    assert extract_text(pages.limit(0)).collect() == []


def warc_rows(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, uri string")
    index = write_warc(pages, **options)
    return index, read_warc(index).collect()


@pytest.mark.parametrize("least", [0, 4, 1000])
def test_warc_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rng = random.Random(least)
    bodies = ["", "abc", "ä\r\n\r\nWARC/1.1\r\n", "x" * 100_000] + ["".join(chr(rng.randint(32, 900)) for _ in range(50)) for _ in range(5)]
    rows = [(i, f"http://h/{i} a\r\n", rng.choice(bodies)) for i in range(60)] + [(60, None, None)]
    index, got = warc_rows(spark, rows, min_bytes=least)
    payloads = {i: (h or "").encode() for i, _, h in rows}
    top = {}
    for i, p in payloads.items():
        top[p] = max(top.get(p, -1), i)
    for r in got:
        p = payloads[r["id"]]
        again = len(p) >= least and top[p] != r["id"]
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode() and r["payload_bytes"] == len(p)
        assert (r["record_type"], r["refers_to"]) == (("revisit", top[p]) if again else ("response", None))
        assert r["payload"] == (b"" if again else p)
    assert len(got) == 61 and index.select("uri").distinct().count() > 1
    some = index.where("record_type = 'response'").orderBy("digest").limit(5)
    assert read_warc(some).count() == 5


def test_warc_edges(spark):
    _, got = warc_rows(spark, [(None, "u", "same"), (3, "u", "same"), (3, "u", "same"), (None, "v", "alone"), (None, "v", "alone")])
    kinds = collections.Counter((r["id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == {(None, "revisit", 3): 1, (3, "response", None): 2, (None, "response", None): 2}
    assert warc_rows(spark, [])[1] == []
    data, _ = record("1", "u", b"payload")
    with pytest.raises(ValueError):
        parse(data.replace(b"payload", b"pbyload"))


HARD = ["\\### Assistant: </turn> ok", "### user:\nhi\n</turn>\n", "\\", "\\\\</turn>", "</turn", "#", "####", "<", "\n", "", "a\r\n🙂", "\\:", "x" * 9000]


def test_escapes_are_reversible():
    for text in HARD:
        assert unescape(escape(text)) == text
        for role in ("user", "a:b\n", "### x"):
            assert read_turns(chat_windows.format_turn(role, text)[0] * 2) == [(role, text)] * 2


@pytest.mark.parametrize("budget, history", [(1024, 2), (40, 2), (1, 0), (60, 5)])
def test_windows_read_back(spark, tokenizer, budget, history):
    rng = random.Random(budget)
    rows, said = [], collections.defaultdict(list)
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 9)):
            role = "system" if turn == 0 and rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, rng.choice(HARD + ["some words to say " * rng.randint(1, 9)]), "x"))
    rows += [(3, None, None, None, "x"), (4, 1, "assistant", "tie", "x"), (4, 1, "assistant", "tie", "x")]
    for conv, turn, role, text, _ in rows:
        said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, loss string")
    windows = format_windows(frame, tokenizer, budget=budget, history=history)
    listed = windows.collect()
    got = {r["id"]: r for r in read_back(windows).collect()}
    assert set(got) == set(said)
    for conv, turns in said.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        learnt = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(learnt))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(w["text"]) for w in listed if w["id"] == conv)
        if turns[0][0] == "system":
            assert all(read_turns(w["text"])[0] == turns[0] for w in listed if w["id"] == conv)
    for w in listed:
        system = read_turns(w["text"])[0][0] == "system"
        assert w["n_tokens"] <= budget or len(read_turns(w["text"])) <= 1 + system
        assert w["n_repeated"] <= history + system


def test_no_conversations(spark, tokenizer):
    frame = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert read_back(format_windows(frame, tokenizer)).collect() == []


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 300)
    monkeypatch.setattr(ann, "QUERIES", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    data = centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 16)) * rng.choice([0.02, 0.5, 2], (1500, 1))
    data[100:400] = data[100]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [
        (2000, None), (2050, [0.0] * 16), (2100, [None] + [1.0] * 15), (2150, [float("nan")] * 16), (2200, [float("inf")] + [1.0] * 15),
        (2250, [1.0, 2.0]), (2251, [2.0, 1.0]), (None, data[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in nearest_neighbours(frame, frame.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert [(v, n) for v, _, n in got.pop(2250)] == [(2251, 1)]
    assert set(got) == set(range(0, 1500, 50))
    norms, hits = np.sqrt((data ** 2).sum(axis=1)), 0
    for q, found in got.items():
        score = (data * data[q]).sum(axis=1) / (norms * norms[q])
        best = np.lexsort((np.arange(1500), -score))
        best = best[best != q][:5]
        hits += len(set(best.tolist()) & {v for v, _, _ in found})
        assert [n for _, _, n in found] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, s, _ in found], score[[v for v, _, _ in found]], rtol=0, atol=1e-14)
    assert [v for v, _, _ in got[150]] == [100, 101, 102, 103, 104]  # ties among copies
    assert hits / (5 * len(got)) >= 0.98
    assert nearest_neighbours(frame.limit(0), frame.limit(0)).collect() == []


def test_neighbours_with_clashing_names(spark):
    rows = [(i, [float(i), 1.0], i, "x", 0.5, 7) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id int, v string, block double, verified int")
    got = nearest_neighbours(frame, frame.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 0] == [1, 2, 3, 4, 5] and len(got) == 10


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_few_vectors_are_verified_and_nearly_all_neighbours_found(spark, folder):
    frame = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    table = frame.toPandas()
    data, ids = np.stack(table["embedding"].to_numpy()).astype(float), table["vec_id"].to_numpy()
    unit = data / np.sqrt((data ** 2).sum(axis=1))[:, None]
    got, hits, verified = nearest_neighbours(frame, frame.where("vec_id % 50 = 0")).toPandas(), 0, []
    for q, found in got.groupby("query_id"):
        score = unit @ unit[np.flatnonzero(ids == q)[0]]
        score[ids == q] = -9
        hits += len(set(ids[np.argsort(-score)[:5]]) & set(found["vec_id"]))
        verified.append(found["n_verified"].iloc[0])
    assert hits / len(got) > 0.95
    assert np.mean(verified) < 0.2 * len(ids)


def test_windows_find_the_text_without_marks(spark):
    """Where the article isn't marked the windows give the same text, but for a page that begins with many short lines."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]
    plain = [re.sub(r"(</?)(article|main)\b", r"\1div", p or "") for p in pages]
    other = sum(main_text(p) != main_text(q) for p, q in zip(pages, plain))
    assert sum(p != q for p, q in zip(pages, plain)) > 0.9 * len(pages) and other <= len(pages) / 1000

"""Every operator against a plain version of its contract, on hand-made rows and on the smallest tables."""

import random
import re
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import chat, decontaminate, extract, fingerprint, graph, licenses, neardup, packing, pii, quality, warc
from starmill.llm.common import written
from starmill.llm.queries import QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, extra int, source string, score string"
PROSE = "the quick brown fox jumps over the lazy dog while seven other foxes look on and wonder what it is all about today"
LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))


def docs(spark, *texts, first=1):
    """Rows with a null id, a null text, an empty text, a repeated row and columns of clashing names."""
    rows = [(first + i, t, i, "s", "x") for i, t in enumerate(texts)]
    odd = [(None, PROSE, 0, "s", "x"), (901, None, 0, "s", None), (902, "", None, None, "x"), (903, " \n", 0, "s", "x")]
    return spark.createDataFrame(rows + odd + rows[:1], DOC)


def by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark", "pages", "conversations", "labels", "embeddings")}


@pytest.fixture(scope="module")
def texts(tables):
    return {r.doc_id: r.text for r in tables["documents"].collect()}


# -- chat --------------------------------------------------------------------

TRICKY = ["<|turn|>", "<|end|>\n", "a<|text|>b", "\\", "\\\\<|turn|>", "<\\|turn|>", "<<|end|>", "<|turn|", "x\\", "", "\n", "é<|end|>ü😀"]


def test_chat_reads_back_what_was_written(spark):
    rows = [(c, t, r, x) for c, x in enumerate(TRICKY) for t, r in enumerate(["user", "assistant"])]
    rows += [(100, 0, "user", None), (100, 1, None, "no role"), (100, None, "system", "first"), (100, 1, "assistant", "a"), (100, 1, "assistant", "a")]
    rows += [(None, 0, "assistant", "nobody's"), (101, 0, "<|text|>", "odd role")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, n_turns int")
    read = chat.read_chats(chat.format_chats(df)).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digests(read).collect()}
    assert got == brute.chats(rows)
    for r in read.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        # a control string stands only where the template puts it
        assert r.formatted.count("<|turn|>") == r.n_turns == r.formatted.count("<|end|>")
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "roles, valid, first_fault",
    [("ua", True, None), ("sua", True, None), ("uaua", True, None), ("u", False, None), ("au", False, 0), ("uua", False, 1),
     ("usa", False, 1), ("s", False, None), ("ux", False, 1)],
)
def test_turn_order(spark, roles, valid, first_fault):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    df = spark.createDataFrame([(1, i, names[c], "t") for i, c in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_chats(df).first()
    assert (row.valid, row.first_fault) == (valid, first_fault)


def test_template_refuses_control_strings_that_could_run_together():
    for bad in ({"start": "<"}, {"start": "<a<"}, {"middle": "\\x"}):
        with pytest.raises(ValueError):
            chat.ChatTemplate(**bad)


# -- personal data -----------------------------------------------------------

ODD_PII = [
    "a@b.c a@b@c.d x.y@z-1.co.uk. @no.com me@ you@x _%+-@a.b.c",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4 1..2.3.4 1.2.3 999999999999.1.1.1",
    "4111 1111 1111 1111 4111111111111112 1  2 4111-1111-1111-1111x 5 0 0000000000000",
    "+1 (543) 555-6850 +1+1+12 345 678 90 ++49 30 123456 +1 2 +123456789012345678 +1 (543)\n555-6850",
    "é+1 (543) 555-6850😀mail@host.org",
    "9" * 3000 + " " + "a." * 2000 + "@" * 2000,
]


def test_base_spans():
    for text in [*ODD_PII, "", PROSE]:
        assert pii.base_spans(text) == brute.base_spans(text)
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789.+-() @ab%\n5.1") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute.base_spans(text), text


@pytest.fixture(scope="module")
def tagger(tables, spark):
    more = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.learn(more)


def test_the_model_finds_rewritten_forms(tagger):
    how = pii.PiiModel()
    found = lambda text: [(k, text[s:e]) for k, s, e in pii.find_spans([text], tagger, how)[0]]
    hits = 0
    for number in ("(543) 555-6850", "543-555-6850", "(212) 555-0199", "212-555-0199", "(800) 555-1234", "800-555-1234"):
        hits += found(f"then thest {number} onhe the") == [("phone", number)]
    assert hits >= 4
    assert found(f"version 2.0.1 of {PROSE}") == [] and found("password=e3b0c44298fc1c149a and 7602ad27cf5550de1c") == []


def test_crf_gradients():
    model, rng = pii.Tagger(pii.PiiModel(hidden=3)), np.random.default_rng(0)
    x, y = rng.integers(1, 40, (6, 3)), np.array([[0, 0, 1], [1, 0, 2], [2, 3, 2], [2, 4, 0], [0, 0, 0], [5, 0, 0]])
    _, grads = model.loss(x, y)
    for key, at in [("w", (2, 3)), ("e", (4,)), ("t", (1, 0)), ("hf", (1, 5)), ("hb", (2, 7)), ("cf", (4,)), ("xf", (x[2, 1], 3)), ("xb", (x[3, 0], 8))]:
        kept = model.p[key][at]
        sides = []
        for shift in (1e-5, -1e-5):
            model.p[key][at] = kept + shift
            sides.append(model.loss(x, y)[0])
        model.p[key][at] = kept
        assert grads[key][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_reconcile_takes_the_best_set_without_overlaps():
    rng = random.Random(1)
    for _ in range(200):
        rows = [(s, s + rng.randrange(1, 6), "ip", rng.random()) for s in (rng.randrange(12) for _ in range(6))]
        best = 0.0
        for pick in range(1 << len(rows)):
            chosen = sorted(rows[i] for i in range(len(rows)) if pick >> i & 1)
            if all(a[1] <= b[0] for a, b in zip(chosen, chosen[1:], strict=False)):
                best = max(best, sum(r[3] for r in chosen))
        value = {(s, e): 0.0 for s, e, _, _ in rows}
        for s, e, _, v in rows:
            value[s, e] = max(value[s, e], v)
        assert sum(value[s, e] for _, s, e in pii.reconcile(rows)) == pytest.approx(best)


class _Marks:
    """Stands in for the tagger: everything but line feeds and padding is an address."""

    def decode(self, x):
        inside = (x != 0) & (x != pii._symbol("\n"))
        tags = np.where(inside, 2, 0)
        tags[0] = np.where(inside[0], 1, 0)
        tags[1:] = np.where(inside[1:] & ~inside[:-1], 1, tags[1:])
        return tags, np.full(x.shape, 0.9)


def test_spans_longer_than_the_stride_are_whole_at_every_offset():
    how = pii.PiiModel()
    for size in [*range(20, 81), 300]:
        for local in {3, size // 2, size - 8}:
            span = "a" * local + " @ " + "b" * (size - local - 5) + ".c"
            texts = ["\n" * at + span + "\n" * (how.window + 1) for at in range(how.window + 1)]
            assert pii.find_spans(texts, _Marks(), how) == [[("email", at, at + size)] for at in range(len(texts))], (size, local)


def test_pii_report_and_mask(spark):
    df = docs(spark, *ODD_PII, PROSE, LONG + " me@example.com").withColumn("n_chars", F.length("text").cast("long"))
    got = by_id(pii.pii_report(df))
    for i, text in enumerate([*ODD_PII, PROSE, LONG + " me@example.com"], 1):
        spans = brute.base_spans(text)
        listed = [f"{k}:{s}:{e}" for k, s, e in spans]
        assert got[i][0].base_sha256 == brute.sha(",".join(listed)) and set(listed) <= set(got[i][0].spans.split(",")) | {""}
        assert got[i][0].n_email == sum(k == "email" for k, _, _ in spans)
    assert len(got[1]) == 2 and got[901][0].spans == "" and len(got[None]) == 1
    masked = pii.mask(df)
    assert masked.columns == df.columns
    rows = by_id(masked)
    assert rows[901][0].text is None and rows[7][0].text == PROSE and rows[8][0].text == LONG + " <email>"
    assert rows[5][0].text == "é<phone>😀<email>" and rows[5][0].n_chars == len(rows[5][0].text)
    assert pii.pii_report(df.limit(0)).count() == 0


# -- licenses ----------------------------------------------------------------

NOTICE = licenses.NOTICES[0].text


def test_licenses(spark):
    cases = [
        "GNU General Public License, gnu GENERAL public\nlicense!", "mit license MIT License mit-license", "cc by by cc by", "apache licensed",
        "gnu general public licence", "É mit license", "x " * 50 + "CC-BY", LONG + " apache license",
        NOTICE.upper(), NOTICE.replace("software you", "thing you"), " ".join(NOTICE.split()[:6]), NOTICE.replace("redistribute it", "hand out and redistribute it"),
    ]
    df = docs(spark, *cases)
    got = by_id(licenses.license_report(df, licenses.license_spans(df)))
    for i, text in enumerate(cases, 1):
        r = got[i][0]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrases(text), text
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
    labels = {i: got[i][0].labels for i in range(1, len(cases) + 1)}
    assert labels[9] == labels[10] == labels[12] == "gpl" and labels[11] == "" and labels[5] == ""
    assert len(got[1]) == 2 and got[901][0].n_words == 0 and got[902][0].score == 0 and got[9][0].score == 1
    assert licenses.license_report(df.limit(0), licenses.license_spans(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        licenses.license_spans(df, (licenses.Template("x", "one"),))


# -- decontamination ---------------------------------------------------------


def test_contamination(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "and"] * 4 + [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, say(30)), (2, say(12)), (3, say(4)), (4, "the the the the the the the the the the the the"), (5, ""), (6, None), (None, say(14)), (3, say(11))]
    items += [(7, items[0][1]), (2, items[1][1])]
    texts = [say(200) for _ in range(20)]
    texts += [say(30) + " " + t.upper() + "! " + say(20) for _, t in items if t]
    texts += [" ".join(items[0][1].split()[3:13]), " ".join(items[0][1].split()[3:12]), "the " * 40, (items[1][1] + " ") * 3, items[1][1].replace(" ", ", ")]
    texts.append(LONG + " " + items[0][1])
    df = docs(spark, *texts)
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    got = by_id(decontaminate.contamination(df, bench))
    want = brute.contamination(texts, items)
    for i, expected in enumerate(want, 1):
        r = got[i][0]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == expected, texts[i - 1][:100]
        assert r.n_near_items >= expected[2]
    assert len(got[1]) == 2 and got[901][0].n_words == 0 and len(got[None]) == 1
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    clean = {i for i, w in enumerate(want, 1) if not w[4]}
    assert {r.doc_id for r in kept.collect()} == clean | {None, 901, 902, 903}
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    """Windows with words put in, left out and moved: the slop is kept to the word, at every distance around it."""
    rng = random.Random(8)
    common = ["the", "of", "and"]
    item = [w for i in range(6) for w in (f"rare{i}", rng.choice(common), rng.choice(common))]
    texts = [" ".join(common * 30), " ".join(item)]
    for extra in (1, 9, 10, 19, 20, 21, 22, 30):
        # the same number of words between the first and the last rare word of a window, or all in one place
        texts.append(" ".join(w for i, w in enumerate(item) for w in [w] + ["of"] * (extra if i == 4 else 0)))
        texts.append(" ".join(w for i, w in enumerate(item) for w in [w] + ["and"] * (extra // 4 if i % 3 == 0 else 0)))
    texts += ["rare0 rare1", "rare0 rare1 rare2", " ".join(reversed(item)), " ".join(rng.sample(item, len(item)))]
    items = [(1, " ".join(item)), (2, "rare1 rare0"), (3, "rare5"), (4, "rare0 unheard-of")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r.n_near_items for r in decontaminate.contamination(df, bench).collect()}
    want = brute.near_items(texts, items)
    assert got == dict(enumerate(want)) and len(set(want)) > 2
    narrow = {r.doc_id: r.n_near_items for r in decontaminate.contamination(df, bench, slop=3).collect()}
    assert narrow == dict(enumerate(brute.near_items(texts, items, slop=3))) and narrow != got


# -- WARC --------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    pages = [(3, "http://c", "same"), (1, "http://a\r\nX: y", "same"), (2, None, ""), (5, "http://e", None), (4, "http://d", "é\r\n\r\nWARC/1.1\r\n"), (None, "http://n", "same"),
             (6, "http://f", "x" * 300_000), (1, "http://a", "same")]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id bigint, url string, html string, offset int").repartition(3)
    warc.write_archives(df, str(tmp_path / "w"))
    rows = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(rows) == len(pages) and not [r for r in rows if r.reason]
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows), key=repr)
    first = {"same": 1, "": 2, pages[4][2]: 4, pages[6][2]: 6}
    want = []
    for page, _, html in pages:
        origin = first[html or ""]
        is_first = origin == page
        want.append((page or 0, "response" if is_first else "revisit", None if is_first else origin, *brute.payload(html)))
    assert got == sorted(want, key=repr)
    assert {r.url for r in rows} == {"http://c", "http://a%0D%0AX: y", None, "http://e", "http://d", "http://n", "http://f", "http://a"}
    warc.write_archives(df.limit(0), str(tmp_path / "empty"))
    assert warc.read_archives(spark, str(tmp_path / "empty")).count() == 0


def test_least_bytes_of_a_revisit(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"), least_bytes=3)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    records = [warc.record_bytes(i, f"http://x/{i}", f"payload {i} ".encode() * 50, None, "2024-01-01T00:00:00Z") for i in range(6)]
    parts = [warc.member(r) if packed else r for r in records]
    whole = b"".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    ids = lambda data: [int(re.search(r"[0-9]+", r.headers["warc-record-id"])[0]) for r in warc.read_archive(data) if not r.reason]
    assert ids(whole) == list(range(6)) and not [r for r in warc.read_archive(whole) if r.reason]
    # a byte is changed: that record alone is lost, and logged with its place
    at = starts[2] + len(parts[2]) // 2
    damaged = whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :]
    assert ids(damaged) == [0, 1, 3, 4, 5]
    gaps = [(r.offset, r.length) for r in warc.read_archive(damaged) if r.reason]
    assert gaps == [(starts[2], len(parts[2]))]
    # bytes are missing, junk is put in, the end is cut off
    inside = starts[3] + len(parts[3]) // 2
    assert ids(whole[:inside] + whole[inside + 20 :]) == [0, 1, 2, 4, 5]
    junk = whole[: starts[1]] + b"\x1f\x8b\x08junk" * 9 + b"\n" + whole[starts[1] :]
    assert ids(junk) == list(range(6)) and sum(r.length for r in warc.read_archive(junk) if r.reason) == 7 * 9 + 1
    assert ids(whole[: starts[5] + 20]) == [0, 1, 2, 3, 4] and list(warc.read_archive(b"")) == []
    assert [r.reason is not None for r in warc.read_archive(b"nothing here")] == [True]


def test_salvage_inside_members(spark, tmp_path):
    records = [warc.record_bytes(i, f"http://x/{i}", random.Random(i).randbytes(3000), None, "2024-01-01T00:00:00Z") for i in range(5)]
    ids = lambda data: [int(re.search(r"[0-9]+", r.headers["warc-record-id"])[0]) for r in warc.read_archive(data) if not r.reason]
    broken = bytearray(records[2])
    broken[-100] ^= 255
    # a bad record in a sound member, and the member after it
    data = warc.member(b"".join([*records[:2], bytes(broken), *records[3:]])) + warc.member(records[0])
    assert ids(data) == [0, 1, 3, 4, 0]
    (gap,) = [r for r in warc.read_archive(data) if r.reason]
    place = sum(map(len, records[:2]))
    assert gap.offset == 0 and gap.reason == f"block digest differs, bytes {place} to {place + len(broken)} of the member"
    # a member cut off, and one with a changed byte near its end: what stands before is read
    whole = warc.member(b"".join(records))
    cut = whole[: len(whole) * 7 // 10]
    assert ids(cut) == [0, 1, 2] and [(r.offset, r.length) for r in warc.read_archive(cut) if r.reason] == [(0, len(cut))]
    at = len(whole) - 500
    damaged = whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :] + warc.member(records[1])
    assert ids(damaged) == [0, 1, 2, 3, 1]
    # headers of any length
    df = spark.createDataFrame([(1, "http://x/" + "u" * 1_200_000, "a"), (2, "http://y", "b")], "page_id bigint, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"))
    assert {(r.page_id, len(r.url), r.reason) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()} == {(1, 1_200_009, None), (2, 8, None)}


# -- extraction --------------------------------------------------------------

PAGES = {
    "plain": ("<html><body><nav><ul><li>Home<li>About</ul></nav><article><h1>Title</h1><p>One &amp; two,\n three.<p>Of.<p><b>Bold</b> it is.</article><footer>(c)</footer>",
              "Title\n\nOne & two, three.\n\nOf.\n\nBold it is."),
    "sides": ("<body><header>Site</header><div class='cookie-notice'>We use cookies, really a lot of them, and more.</div><main><aside>See also</aside><p>The text of the page is here, at last."
              "</p><div class=ad>Buy!</div><p>And here.</p><form><input><label>Mail</label></form><section id=comments><p>First!</p><article class='comment'>Nice, very nice indeed.</article></section></main>",
              "The text of the page is here, at last.\n\nAnd here."),
    "no article": ("<div id=top><a href=/>Home</a> | <a href=/x>X</a></div><div id=body><p>A long paragraph, with commas, and a full stop. And one more sentence, too.</p><p>Short.</p></div>"
                   "<script>var a='<p>no</p>';</script><style>p{}</style>",
                   "A long paragraph, with commas, and a full stop. And one more sentence, too.\n\nShort."),
    "unclosed": ("<article><p>a &lt;b&gt; &eacute; &#x41;&nbsp;c<br>d<!-- <p>no -->", "a <b> é A c d"),
    "empty": ("", ""), "null": (None, ""), "no text": ("<nav>x</nav>", ""),
}


def test_main_text(spark):
    df = spark.createDataFrame([(i, f"http://{k}", h, "x") for i, (k, (h, _)) in enumerate(PAGES.items())], "page_id bigint, url string, html string, text string")
    got = {r.url[7:]: (r.text, r.n_chars) for r in extract.extract(df).collect()}
    assert got == {k: (t, len(t)) for k, (_, t) in PAGES.items()}
    assert extract.extract(df.limit(0)).count() == 0
    assert extract.main_text("<div>" * 3000 + "deep") == "deep" and extract.main_text("<" * 5000).strip("<") == ""


TEXT = "Some prose, with commas, that goes on for a while. It has full stops, too; and more."


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "content-sidebar-wrap", "post no-comments", "with-header", "search-results", "comments-open"])
@pytest.mark.parametrize("inner", [f"<article><p>{TEXT}</p></article>", f"<p>{TEXT}</p>"])
def test_wrappers_with_marked_names_keep_their_text(name, inner):
    side = "<div class='sidebar'>See also</div>"
    assert extract.main_text(f"<body><div class='{name}'>{side}{inner}</div></body>") == TEXT
    assert extract.main_text(f"<body><div id=top>Home | Us</div><div class='{name}'>{inner}{side}</div></body>") == TEXT


def test_all_content_elements_are_kept():
    parts = [f"{i}. {TEXT}" for i in range(4)]
    articles = "<article>" + "".join(f"<p>{t}" for t in parts[:3]) + f"</article><article><p>{parts[3]}</article>"
    assert extract.main_text(f"<body>{articles}</body>") == "\n\n".join(parts)
    divs = "<div>" + "".join(f"<p>{t}</p>" for t in parts[:3]) + f"</div><div><h2>Last</h2><p>{parts[3]}</p></div>"
    page = f"<body><div><a href=/>Home</a> | <a href=/x>X</a></div><div>{divs}</div><div>(c) us</div></body>"
    assert extract.main_text(page) == "\n\n".join([*parts[:3], "Last", parts[3]])
    # an advert that outweighs a short article, and comments that outweigh all
    assert extract.main_text(f"<body><div class=ad>{TEXT * 5}</div><article><p>Short.</article></body>") == "Short."
    assert extract.main_text(f"<body><div><p>{TEXT}</div><div id=comments><p>{TEXT * 5}</div></body>") == TEXT


def test_weights_select(monkeypatch):
    """Pages without article elements: weights drawn at random give other texts on most of them."""
    rng = random.Random(5)
    pages = []
    for _ in range(40):
        short = ["".join(f"<div><a href=/>{rng.choice(['Home', 'Top 10', 'All of it'])}</a></div>" for _ in range(rng.randint(1, 4))) for _ in range(2)]
        pages.append((f"<body><div>{short[0]}</div><div><div><h1>Title</h1>" + "".join(f"<p>{TEXT * rng.randint(1, 4)}</p>" for _ in range(rng.randint(2, 6))) + f"</div></div><div>{short[1]}</div></body>"))
    texts = [extract.main_text(p) for p in pages]
    assert all(t.startswith("Title\n\nSome") and t.endswith("more.") for t in texts)
    monkeypatch.setattr(extract, "path_weights", lambda blocks: np.array([rng.random() for _ in blocks]))
    assert sum(extract.main_text(p) != t for p, t in zip(pages, texts, strict=True)) > 30


def test_very_deep_pages():
    began = time.perf_counter()
    assert extract.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert time.perf_counter() - began < 2


# -- packing -----------------------------------------------------------------


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    cases = [PROSE, LONG, "Émile's café №5 ﬁn ... !!! 中文字 😀", "a\tb\r\nc\x0b\x0cd e f", "x" * 9000, "don't we'll I'm", "İstanbul ß é", "<|endoftext|> <|startoftext|>x"]
    df = docs(spark, *cases).repartition(3)
    pieces = packing.pack(df, tokenizer_path(), 256).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    want = {i: t for i, t in enumerate(cases, 1)} | {None: PROSE, 901: None, 902: "", 903: " \n"}
    for doc, text in want.items():
        ids, crc = brute.pieces(text, tokenizer)
        copies = 2 if doc == 1 else 1
        assert sum(p.length for p in by_doc[doc]) == copies * len(ids)
        covered = sorted((p.start, p.length) for p in by_doc[doc])
        assert covered == sorted(packing.cuts(len(ids), 256) * copies)
        for p in by_doc[doc]:
            assert p.doc_tokens == len(ids) and zlib.crc32(p.ids) == crc(p.start, p.length) and p.offset == 0
            assert p.length & (p.length - 1) == 0
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces)))
    # buckets: longer sequences come first
    ordered = [p.length for p in sorted(pieces, key=lambda p: p.sequence_id)]
    assert ordered == sorted(ordered, reverse=True)
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, tokenizer_path(), 1000)


# -- quality -----------------------------------------------------------------


def test_gam_learns_steps_and_interactions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality.fit(x[:3000], y[:3000], quality.Training())
    alone = quality.fit(x[:3000], y[:3000], quality.Training(pairs=0))
    right = [((m.score(x[3000:]) > 0.5) == y[3000:]).mean() for m in (model, alone)]
    assert right[0] > 0.9 > right[1]
    step = (x[:, 3] > 0.5).astype(float)
    assert ((quality.fit(x[:3000], step[:3000], quality.Training()).score(x[3000:]) > 0.5) == step[3000:]).mean() > 0.98
    raw = model.raw(x[:5])
    tables = [model.base + sum(t[np.searchsorted(e, row[j], side="right")] for j, (t, e) in enumerate(zip(model.tables, model.edges, strict=True)))
              + sum(t[tuple(np.searchsorted(model.pair_edges[k], row[k], side="right") for k in pair)] for pair, t in model.pair_tables.items()) for row in x[:5]]
    assert raw == pytest.approx(tables)


def test_quality(spark):
    path = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    report = quality.quality_report(documents, labels)
    both = report.join(labels, "doc_id").filter("held_out").toPandas()
    assert len(both) > 500 and (both.predicted == both.quality).mean() > 0.97
    assert report.filter("held_out <> (crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2)").count() == 0
    odd = docs(spark, PROSE, LONG)
    scored = quality.score_quality(odd, quality.learn(documents, labels))
    assert set(scored.columns) == {*odd.columns, "predicted"} and scored.filter("score between 0 and 1").count() == odd.count()
    # nothing to learn from: nothing is rejected
    assert quality.quality_report(odd, labels.limit(0)).filter("predicted = 0").count() == 0
    assert quality.quality_report(odd.limit(0), labels).count() == 0


# -- near-duplicates ---------------------------------------------------------


def edited(text, share, rng):
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(500)) for _ in range(150)) for _ in range(6)]
    texts = [b for b in base] + [edited(base[0], s, rng) for s in [0.005, 0.01, 0.02, 0.03, 0.05] * 12] + [base[1].upper(), "a b c", "A  B\tc", "a b d"]
    # chains: neighbours are near, ends are not
    chain = base[2].split()
    for i in range(10):
        chain[i * 9 : i * 9 + 3] = [f"q{i}{k}" for k in range(3)]
        texts.append(" ".join(chain))
    texts += [LONG, LONG + " end", base[3] + " É", base[3] + " é"]
    # one long passage in otherwise different texts
    texts += [base[4] + " " + " ".join(f"p{i}x{k}" for k in range(150)) for i in range(20)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    df = docs(spark, *texts)
    got = by_id(neardup.near_duplicates(df))
    want = brute.components([(i, t) for i, t in enumerate(texts, 1)])
    assert {i: (got[i][0].n_shingles, got[i][0].component_id) for i in want} == want
    assert got[901][0].component_id == 901 and got[902][0].kept and got[None][0].component_id is None and got[None][0].kept
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [*{c for _, c in want.values()}, None, 901, 902, 903]))
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    assert got == {x: root(x) for x in parent}


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    """Groups of near copies are stars from the start: their links were gone through again after every step."""
    rounds = []
    large_star = graph._large_star
    monkeypatch.setattr(graph, "_large_star", lambda edges: rounds.append(edges.count()) or large_star(edges))
    frame = lambda links: spark.createDataFrame(links, "u bigint, v bigint")
    found = lambda df: {r.node: r.component for r in df.collect()}
    stars = graph.connected_components(frame([(0, i) for i in range(1, 200)] + [(i, 300) for i in range(300, 400)]))
    assert found(stars) == {i: 0 if i < 200 else 300 for i in [*range(200), *range(300, 400)]} and not rounds
    # two components, nodes that were alone and a link inside a component
    joined = graph.with_links(stars, frame([(150, 399), (1, 2), (500, 399), (700, 600), (650, 700)]))
    assert found(joined) == {i: 0 for i in [*range(200), *range(300, 400), 500]} | {600: 600, 650: 600, 700: 600}
    assert sum(rounds) < 20
    assert found(graph.with_links(stars, frame([(1, 1)]))) == found(stars)
    assert found(graph.with_links(stars.limit(0), frame([(2, 1), (2, 3)]))) == {1: 1, 2: 1, 3: 1}


def test_written_tables_leave_no_shuffle_files(spark):
    """They stayed until the driver's memory was cleaned, and counted with those of the next steps."""

    def held():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().iterator()
        found = set()
        while blocks.hasNext():
            found.add(blocks.next().toString())
        return {b for b in found if b.startswith("shuffle_")}

    before = held()
    written(spark.range(1000).repartition(4).groupBy("id").count(), "counts")
    until = time.time() + 10
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before


# -- fingerprints ------------------------------------------------------------


def test_fingerprints(spark):
    rng = random.Random(6)
    texts = [PROSE, LONG[:20_000], "", "a", "ab", "abc", "é😀ü" * 9, "".join(rng.choice("abcdefgh ") for _ in range(3000))]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts, 1)] + [(50, None, 1)], "doc_id bigint, text string, fingerprint int").repartition(4)
    got = {r.doc_id: r for r in fingerprint.fingerprints(df).collect()}
    want = brute.edited({**dict(enumerate(texts, 1)), 50: ""})
    assert {i: r.edited_sha256 for i, r in got.items()} == {i: brute.sha(t) for i, t in want.items()}
    assert got[2].near_edited > 0.55 > got[2].near_next and got[50].fingerprint == "" and got[4].near_edited == 1
    # repeated rows and null ids: every row has a result; equal texts, equal fingerprints
    many = docs(spark, PROSE, "x " + PROSE)
    rows = fingerprint.fingerprints(many).collect()
    assert len(rows) == many.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (1, None)}) == 1
    one = fingerprint.fingerprints(df.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1 and fingerprint.fingerprints(df.limit(0)).count() == 0


def test_walks_side_by_side_are_walks_alone():
    how, rng = fingerprint.EditEmbedding(), np.random.default_rng(3)
    texts = [rng.integers(97, 120, n).astype(np.uint32) for n in (0, 1, 5, 5, 300, 40)]
    begins = np.array([0, 7, 0, 4095, 0, 9])
    spent, _, _ = fingerprint._tables(how)
    for text, begin, got in zip(texts, begins, fingerprint.walk(texts, begins, how, block=20), strict=True):
        t, steps = int(begin), []
        for c in text:
            steps.append(t)
            kind = int(fingerprint._mixed(np.array([c]))[0] >> np.uint64(40)) % how.classes
            t += int(spent[kind * how.period + t % how.period])
        assert got.tolist() == [*steps, t]


def test_near_texts(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(2000)) for _ in range(5)]

    def touched(text, n):
        chars = list(text)
        for _ in range(n):
            chars[rng.randrange(len(chars))] = rng.choice(["", "z", "yy"])
        return "".join(chars)

    texts = [(10 * b + k, touched(t, k)) for b, t in enumerate(base) for k in range(4)]
    df = spark.createDataFrame([*texts, (900, "")], "doc_id bigint, text string")
    groups = {r.doc_id: r.group_id for r in fingerprint.near_texts(fingerprint.fingerprints(df)).collect()}
    right = sum(groups[i] == i // 10 * 10 for i, _ in texts)
    assert right >= 0.9 * len(texts) and groups[900] == 900
    assert all(g // 10 == i // 10 for i, g in groups.items())


def near_groups(prints):
    """Brute force: doc_id -> smallest id that near fingerprints reach; one fingerprint to an id."""
    how, parent = fingerprint.EditEmbedding(), {i: i for i in prints}
    codes = {i: np.frombuffer(p.encode(), np.uint8) for i, p in prints.items()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in prints:
        for j in prints:
            if i < j and prints[i] and prints[j] and fingerprint.likeness(codes[i], codes[j], how) >= how.near:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in prints}


def test_near_texts_links_whatever_octaves_agree(spark):
    rng = random.Random(9)
    draw = lambda n: [rng.choice("0123456789abcdef") for _ in range(n)]
    prints = {}
    for i in range(0, 120, 3):
        # six whole octaves and an unfinished one: the walk ends where the third octave ahead would be whole
        first = draw(64 * 6 + rng.choice([1, 40, 63, 63]))
        second, third = list(first), list(first)
        for k in range(64 * 4, 64 * 6):
            if rng.random() < 0.58:
                second[k] = rng.choice("0123456789abcdef".replace(first[k], ""))
        for k in range(64 * 5, len(first)):
            if rng.random() < 0.2:
                third[k] = rng.choice("0123456789abcdef")
        prints |= {i: "".join(first), i + 1: "".join(second), i + 2: "".join(third[: len(third) - rng.choice([0, 0, 2])])}
    prints |= {900: "", 901: "", 902: prints[0], 903: "0", 904: "0"}
    df = spark.createDataFrame([*prints.items(), (None, prints[0]), (900, "")], "doc_id bigint, fingerprint string")
    got = fingerprint.near_texts(df).collect()
    want = near_groups(prints)
    assert len(got) == len(prints) + 1 and {r.doc_id: r.group_id for r in got} == want
    assert sum(want[i + 1] == want[i] for i in range(0, 120, 3)) >= 5
    rows = fingerprint.with_groups(df).collect()
    assert len(rows) == df.count() and [r.group_id for r in rows if r.doc_id is None] == [None]


def test_registered_fingerprints_have_their_groups(spark):
    rows = QUERIES["op10_fingerprint"](spark, SF_DIR).collect()
    assert {r.doc_id: r.group_id for r in rows} == near_groups({r.doc_id: r.fingerprint for r in rows})


# -- registered queries ------------------------------------------------------


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs_over_its_whole_table(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.toPandas()
    source = {"op1_chat": "conversations", "op5_warc": "pages", "op6_extract": "pages", "op13_whitening": "embeddings"}.get(name, "documents")
    key = {"conversations": "conv_id", "pages": "page_id", "documents": "doc_id", "embeddings": "vec_id"}[source]
    ids = {r[0] for r in tables[source].select(key).distinct().collect()} | ({-7} if name == "op1_chat" else set())
    assert set(rows[key]) == ids
    if name != "op7_packing":
        assert len(rows) == len(ids) * (8 if name == "op13_whitening" else 1)


def test_queries_against_brute_force(spark, tables, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_neardup"](spark, SF_DIR).collect()}
    assert got == brute.components(list(texts.items()))
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, SF_DIR).collect()}
    for i, text in texts.items():
        assert got[i].base_sha256 == brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in brute.base_spans(text)))
    edits = brute.edited(texts)
    for r in QUERIES["op10_fingerprint"](spark, SF_DIR).collect():
        assert r.edited_sha256 == brute.sha(edits[r.doc_id])

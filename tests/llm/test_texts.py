import base64
import functools
import gzip
import hashlib
import random
import re
import zlib
from urllib.parse import quote

import pytest

from newstide.llm import pii, secret_scan
from newstide.llm.html_text import extract_text, visible_text
from newstide.llm.secret_scan import KINDS, find_secrets, scan_secrets

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_pii(text):
    kinds = list(PATTERNS)
    spans = [
        (m.start(), kinds.index(k), m.end())
        for k, p in PATTERNS.items()
        for m in re.finditer(p, text or "")
        if passes(k, m[0])
    ]
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


PII_TEXTS = [
    "mail a.b@c.de, x@y, q@w@e.fr a@b.c_d@e.f %@-.-", "ip 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111", "call +1 (415) 555-0100 or +49-30.123456 +1 2",
    "é😀 jo@ex.org +33 1 23 45 67 89 4111111111111111", "1 " * 4000, "a." * 800 + "@" + "b." * 800 + "c", "9" * 3000,
    "@" * 500, "visa 5500 0000 0000 0004 5500 0000 0000 0004", "phone 415-555-0199 tel 415-555-0198 fax (415) 555-0197",
    "write to jo [at] ex [dot] org",
]


def test_pii_base_equals_brute_force_and_stays(documents, awkward, spark):
    rng = random.Random(8)
    noise = ["".join(rng.choice("0123456789 .-+@a()") for _ in range(300)) for _ in range(40)]
    rows = awkward + [(1000 + i, t, "en", "a") for i, t in enumerate(PII_TEXTS + noise)]
    found = pii.find_pii(documents(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(r[:2] for r in rows)
    for r in found:
        base = base_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), texts[r.doc_id][:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(f"{k}:") for k in PATTERNS]
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.find_pii(documents(rows).limit(0)).count() == 0


def test_pii_labelers_add_spans(documents):
    rows = [(i, f"please call the phone 415-555-0{100 + i} or mail jo{i}@ex.org", "en", "a") for i in range(30)]
    rows += [(100 + i, f"see version 12 page 300-400-{5000 + i}", "en", "a") for i in range(30)]
    added = {r.doc_id: r.n_added for r in pii.find_pii(documents(rows)).collect()}
    assert sum(added[i] for i in range(30)) > sum(added[100 + i] for i in range(30))


def test_em_finds_the_unreliable_labeler():
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.5
    accuracy = [0.95, 0.9, 0.85, 0.6]
    votes = np.stack([np.where((rng.random(4000) < a) == truth, 1, -1) for a in accuracy], 1)
    p, right = pii.reliabilities(np.zeros(4000, int), votes, np.ones(4000))
    assert np.mean((p > 0.5) == truth) > 0.93
    assert right[1][3] < right[1][1] < right[1][0] + 0.02


def test_training_weighs_every_candidate_alike(spark):
    import numpy as np

    names = ["kind", *pii.VOTES, *pii.FEATURES]
    cells = [
        ([0, 1, 1, 0, -1, 1, 2, 0, 1], 40), ([0, 1, -1, 1, 1, 2, 1, 1, 0], 3), ([2, -1, 1, -1, 1, 0, 3, 1, 0], 7),
        ([2, -1, -1, 0, -1, 2, 2, 0, 0], 300), ([3, 1, 0, 1, 1, 3, 1, 2, 1], 25), ([3, -1, 0, -1, 1, 1, 1, 1, 0], 60),
    ]
    every = [values for values, n in cells for _ in range(n)]
    shape = ", ".join(f"{name}: int" for name in names)
    spans = spark.createDataFrame([([tuple(v) for v in every],)], f"spans array<struct<{shape}>>")
    table = np.array(every, float)
    kinds, votes = table[:, 0].astype(int), table[:, 1 : 1 + len(pii.VOTES)]
    x, ones = pii.design(kinds, votes, table[:, 1 + len(pii.VOTES) :]), np.ones(len(table))
    p, _ = pii.reliabilities(kinds, votes, ones)
    assert np.allclose(pii.train(spans), pii.fit_classifier(x, p, ones), atol=1e-6)


def base_secrets(text):
    text, found = text or "", []
    for m in re.finditer(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A
    ):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


SECRET = "password = hunter22x"


def wraps():
    b64 = lambda t: base64.b64encode(t.encode() if isinstance(t, str) else t).decode()
    return {
        "url": quote(SECRET, safe=""),
        "url twice": quote(quote(SECRET, safe=""), safe=""),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "entities": "".join(f"&#{ord(c)};" for c in SECRET),
        "base64": b64(SECRET),
        "base64 thrice": b64(b64(b64(SECRET))),
        "url-safe": base64.urlsafe_b64encode(f"??>>{SECRET}".encode()).decode(),
        "gzip": b64(gzip.compress(SECRET.encode())),
        "mixed": quote(b64(gzip.compress(b64(quote(SECRET, safe="")).encode()))),
    }


@pytest.mark.parametrize("how", list(wraps()))
def test_layers_are_unwrapped_and_mapped(how):
    wrapped = wraps()[how]
    text = f"é before {wrapped} after"
    base, more = find_secrets(text)
    start, end = text.index(wrapped), text.index(wrapped) + len(wrapped)
    hits = [s for s in more if s[0] == "assign"]
    assert hits and all(start <= s[1] < s[2] <= end for s in hits), (base, more)
    if how in ("url", "unicode", "entities"):
        assert ("assign", start, end) in hits


def test_cycles_end_and_plain_text_gives_nothing_more():
    assert find_secrets("100%25 done %41%42 \\u0041 plainwordsthatarelong")[1] == []
    assert find_secrets(base64.b64encode(gzip.compress(b"x" * 10_000_000)).decode())[1] == []


@functools.cache
def packed_layers():
    rng, plain = random.Random(4), SECRET.encode()
    noise = bytes(rng.choice(b"0123456789abcdef ,") for _ in range(300_000)).replace(b"ab", b",")
    deep = plain
    for _ in range(120):
        deep = gzip.compress(deep)
    return {
        "members": gzip.compress(b"hello ") + gzip.compress(plain),
        "split members": gzip.compress(b"passw") + gzip.compress(b"ord = hunter22x"),
        "padded members": gzip.compress(b"hello ") + b"\0" * 700 + gzip.compress(plain),
        "behind the data": gzip.compress(b"hello ") + plain,
        "beyond 16 MB": gzip.compress(b"a lot, " * (3 << 20) + plain),
        "characters of two bytes": gzip.compress("é, ".encode() * (6 << 20) + plain),
        "deep": deep,
        "zlib": zlib.compress(noise + b" " + plain),
        "below 16 MB": gzip.compress(b"one, " * (4 << 20) + base64.b64encode(gzip.compress(plain))),
    }


@pytest.mark.parametrize("how", list(packed_layers()))
def test_compressed_layers_are_read_whole(how):
    wrapped = base64.b64encode(packed_layers()[how]).decode()
    more = find_secrets(f"é before {wrapped} after")[1]
    assert {s for s in more if s[0] == "assign"} == {("assign", 9, 9 + len(wrapped.rstrip("=")) + wrapped.count("="))}


def test_pieces_lose_nothing_wherever_they_end():
    for middle in ("password   =   hunter22x", quote(SECRET), base64.b64encode(gzip.compress(SECRET.encode())).decode()):
        for lead in range(40):
            content = "one, two " + "wo " * lead + middle + " and more text, " * 9
            text = base64.b64encode(gzip.compress(content.encode())).decode()
            assert find_secrets(text, 32)[1] == [("assign", 0, len(text))], (middle, lead)


def test_compressed_content_that_holds_itself_ends(monkeypatch):
    data, opened = gzip.compress(SECRET.encode()), []
    monkeypatch.setattr(secret_scan, "inflated", lambda file, piece: iter([opened.append(1) or data]))
    assert find_secrets(base64.b64encode(data).decode())[1] == [] and len(opened) == 1


def folded(data, width, end="\n"):
    text = base64.b64encode(data).decode()
    return end.join(text[i : i + width] for i in range(0, len(text), width))


def broken_runs():
    plain, rng = SECRET.encode(), random.Random(8)
    long = "".join(rng.choice("abcdefghij ,") for _ in range(300)).encode() + plain
    noise = bytes(rng.randrange(256) for _ in range(400))
    b64 = lambda data: base64.b64encode(data).decode()
    return {
        **{f"lines of {w}": folded(long, w) for w in (64, 70, 76)},
        **{f"packed lines of {w}": folded(gzip.compress(long), w, "\r\n  ") for w in (64, 76)},
        "packed lines behind text": "data-" + folded(gzip.compress(noise + plain), 76),
        "lines in lines": folded(folded(long, 76).encode(), 64),
        "packed folded lines": b64(gzip.compress(folded(gzip.compress(long), 76).encode())),
        "NUL": b64(b"begin\0" + plain),
        "form feed": b64(b"begin " * 50 + b"\f" + plain + b"\x1b[0m"),
        "bytes": b64(noise + b" " + plain + b" " + noise),
        "glued to -": "id-" + b64(plain),
        "glued to _": "some_id_" + b64(plain),
        "glued to +": "a+bc+" + b64(plain),
        "glued packed": "id_" + b64(gzip.compress(plain)),
        "glued zlib": "id-no-" + b64(zlib.compress(plain)),
        "packed glued to packed": b64(gzip.compress(b"nothing here")).rstrip("=") + "-" + b64(gzip.compress(plain)),
        "packed within bytes": b64(b"\1\2" + gzip.compress(plain)),
        "url with a bad byte": "%FF" + "".join(f"%{c:02x}" for c in b" " + plain),
    }


@pytest.mark.parametrize("how", list(broken_runs()))
def test_broken_runs_are_unwrapped_and_mapped(how):
    wrapped = broken_runs()[how]
    for text in (f"é before {wrapped} after", f"é\n{wrapped}\nSincerely", f"before: {wrapped}"):
        start, end = text.index(wrapped), text.index(wrapped) + len(wrapped)
        hits = [s for s in find_secrets(text)[1] if s[0] == "assign"]
        assert hits and all(start <= s[1] < s[2] for s in hits)
        assert any(s[2] >= end - 8 for s in hits) or how in ("form feed", "bytes")
        assert all(s[2] <= end for s in hits) or text.endswith("Sincerely")


def test_lines_of_their_own_stay_apart():
    secrets = [f"token = {c * n}" for c, n in (("ab", 6), ("cd", 5), ("ef", 9), ("gh", 7))]
    lines = [base64.b64encode(t.encode()).decode().rstrip("=") for t in secrets]
    text = "\n".join(lines)
    spans = {("assign", text.index(line), text.index(line) + len(line)) for line in lines}
    assert spans <= set(find_secrets(text)[1])
    lines = [base64.b64encode(gzip.compress(t.encode())).decode().rstrip("=") for t in secrets]
    text = "\n".join(lines)
    assert all(any(a <= text.index(x) < b for _, a, b in find_secrets(text)[1]) for x in lines)


def test_secret_base_equals_brute_force(documents, awkward):
    rng = random.Random(9)
    noise = ["".join(rng.choice(["token", "Secret", "=", ":", '"', " ", "ab", "0f", "AKIA", "Z9", "password"]) for _ in range(150)) for _ in range(40)]
    rows = awkward + [(1000 + i, t, "en", "a") for i, t in enumerate([*noise, *wraps().values(), "ſecret=abcdefg", "a" * 100_000])]
    texts = dict(r[:2] for r in rows)
    found = scan_secrets(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        base = base_secrets(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [base.count(f"{k}:") for k in KINDS]
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))
    assert scan_secrets(documents(rows).limit(0)).count() == 0


PAGES = {
    "<p>One<p>Two": "One\n\nTwo",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol><li>a</li><li>b</li></ol>": "1. a\n2. b",
    "<table><tr><th>name<td>x<tr><td>long name<td>y z</table>": "name       x\nlong name  y z",
    "<table><tr><td colspan=2>wide cell</td><td>c</td></tr><tr><td>a</td><td>b</td><td>d</td></tr></table>": "wide cell  c\na  b       d",
    "a<script>if (x<y) {'</p>'}</script>b<style>p{}</style><!-- no -->c": "abc",
    "<div>a</div><div hidden>b</div><div style='display : none'>c</div><span style=\"visibility:hidden\">d</span>e": "a\ne",
    "<pre>x\n  y</pre>z": "x\n  y\n\nz",
    "a<br>b &amp; &lt;c&gt; &eacute;": "a\nb & <c> é",
    "<head><title>no</title></head><body>yes</body>": "yes",
    "<p>a</div>b</p>": "ab",
    "1 < 2 and <b>bold</b": "1 < 2 and bold</b",
    "<a title='x > y'>link</a>": "link",
    "": "",
}


@pytest.mark.parametrize("html", list(PAGES))
def test_visible_text(html):
    assert visible_text(html) == PAGES[html]


SPANNED = {
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a  b\n   c\nd  e",
    "<table><tr><td>a<td rowspan='3' colspan=2>wide<td>b<tr><td>c<td>d<tr><td>e<td>f</table>": "a  wide  b\nc        d\ne        f",
    "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>": "a  b\n   c\nd  e",
    "<table><tr><td rowspan=9>a<td>b</tr></table><table><tr><td>c<td>d</table>": "a  b\n\nc  d",
}


@pytest.mark.parametrize("html", list(SPANNED))
def test_cells_that_span_rows_keep_their_column(html):
    assert visible_text(html) == SPANNED[html]


def test_deep_elements_keep_their_meaning():
    for n in (149, 200, 3000):
        inner = "<div>" * n + "unseen" + "</div>" * n
        assert visible_text(f"<p>a</p><div hidden>{inner}<p>unseen too</div><p>b</p>") == "a\n\nb"
        assert visible_text("<font>" * n + "<div>a<span hidden>no</span></div><pre>x\n  y</pre>") == "a\n\nx\n  y"
        assert visible_text("<a name=x>" * n + "<table><tr><td>aa<td>b<tr><td>c<td>d</table>") == "aa  b\nc   d"
    assert visible_text("<table><tr><td>" * 400 + "in" + "</table>" * 400 + "out") == "in\n\nout"
    assert visible_text("<i><div>" * 50_000 + "deep") == "deep"


def test_extract_text(spark, rows):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    pages = [(i, h, "clash") for i, h in enumerate(PAGES)] + [(100, None, "c"), (101, deep, "c"), (101, deep, "c"), (None, "<p>x", "c")]
    df = spark.createDataFrame(pages, "page_id long, html string, text string")
    assert rows(extract_text(df)) == sorted(
        [(i, t) for i, t in enumerate(PAGES.values())] + [(100, ""), (101, "deep"), (101, "deep"), (None, "x")],
        key=lambda r: (r[0] is not None, r[0] or 0),
    )
    assert extract_text(df.limit(0)).count() == 0

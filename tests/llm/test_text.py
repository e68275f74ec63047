"""Pseudonyms, secrets and page text."""

import base64
import hashlib
import json
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from scorebook.llm import html_text, pii, secrets


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.binary(max_size=8))
def test_feistel_is_a_permutation(size, key):
    f = pii.Feistel(key, "t", size)
    got = [f.apply(v) for v in range(size)]
    assert sorted(got) == list(range(size)) and [f.invert(v) for v in got] == list(range(size))


SAMPLES = ["bob.Smith42@Mail7.example.com", "4845168114407329", "4845-1681-1440-7329", "+1 (974) 555-3436", "974-555-3436",
           "97.51.17.173", "2024-02-29", "29.02.2024", "GB82 WEST 1234 5698 7654 32", "123-45-6789", "+49 30 1234567"]


def test_pseudonyms_keep_the_format_and_validate():
    p, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", "invert")
    for s in SAMPLES:
        new, found = p.replace(f"see {s} there")
        assert len(found) == 1 and s not in new, s
        shape = lambda x: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", x)))
        if found[0][2] != "ip":
            assert shape(new) == shape(f"see {s} there")
        assert len(p.find(new)) == 1 and back.replace(new)[0] == f"see {s} there"


def test_equal_values_are_linked_and_keys_differ():
    p = pii.Pseudonyms(b"k")
    digits = lambda x: re.sub(r"\D", "", p.replace(x)[0])
    assert digits("4845168114407329") == digits("4845-1681-1440-7329")
    assert digits("+1 (974) 555-3436")[1:] == digits("974-555-3436")
    iso, dots = p.replace("2024-02-29")[0].split("-"), p.replace("29.02.2024")[0].split(".")
    assert iso == dots[::-1]
    assert p.replace("a@b.example.com")[0].lower() == p.replace("A@B.example.com")[0].lower()
    assert pii.Pseudonyms(b"other").replace("4845168114407329")[0] != p.replace("4845168114407329")[0]


def test_numbers_that_do_not_validate_stay():
    text = "7536784127813051 2023-02-29 999.1.2.3 666-12-1234 12345678 GB00 WEST 1234 5698 7654 32 v1.2.3.4.5 100 200"
    assert pii.Pseudonyms().replace(text) == (text, [])


def test_neighbouring_finds():
    new, found = pii.Pseudonyms().replace("+1 (826) 555-4081 190.137.223.204 7536784127813051 4845168114407329")
    assert [k for _, _, k, _ in found] == ["phone", "ip", "card"] and "7536784127813051" in new


def whole_text_find(p, text):
    """``find`` by running every kind's own pattern over the whole text."""
    got = []
    for kind, pattern, method in (("email", pii._EMAIL, "email"), ("iban", pii._IBAN, "iban"),
                                  ("date", pii._WRITTEN, "written"), *((k, p, k) for k, p in pii.NUMBERS)):
        at = 0
        for a, b in sorted((a, b) for a, b, _, _ in got) + [(len(text), len(text))]:
            for m in pattern.finditer(text, at, max(at, a)):
                new = getattr(p, method)(m[0])
                if new is not None:
                    got.append((m.start(), m.end(), kind, new))
            at = max(at, b)
    return sorted(got)


def test_values_beside_letters_and_marks():
    p = pii.Pseudonyms()
    for text, kind in (("2024-01-02T10:00:00Z", "date"), ("log_2024-01-02.txt", "date"), ("ssn_123-45-6789", "ssn"),
                       ("Tel.974-555-3436", "phone"), ("Tel.(974) 555-3436", "phone"), ("974-555-3436ext", "phone"),
                       ("card4845168114407329", "card"), ("4845168114407329x", "card"), ("v_97.51.17.173_a", "ip")):
        assert [k for _, _, k, _ in p.find(text)] == [kind], text
    for text in ("2024-01-02/", "123-45-6789-", "see 2024-01-02/x"):
        assert p.find(text) == whole_text_find(p, text) == []


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*SAMPLES, "2024-1-2", "1.1.1.1", "(974) 555-3436", "12", "7", "a", "T", "_", "é", "٣", " ",
                                 "  ", ".", "-", "/", ":", "(", ")", "+", "+1", "@", "\n", "x.com"]), max_size=12))
def test_find_equals_the_patterns_over_the_whole_text(parts):
    p = pii.Pseudonyms()
    assert p.find("".join(parts)) == whole_text_find(p, "".join(parts))


def test_pseudonymise_odd_rows(odd_docs, no_docs):
    out = pii.pseudonymise(odd_docs.withColumnRenamed("h", "n_card"))
    assert out.count() == odd_docs.count() and out.columns[-7:] == [f"n_{k}" for k in pii.KINDS]
    before = sorted((str(r.doc_id), str(r.text)) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == before
    assert pii.pseudonyms_of(no_docs).count() == 0


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def number(n, size):
    return der(2, (n | 1 << (8 * size - 2)).to_bytes(size, "big"))


RNG = random.Random(9)
PKCS1 = der(0x30, der(2, b"\0"), *(number(RNG.getrandbits(500), 64) for _ in range(8)))
RSA = der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5))
PKCS8 = der(0x30, der(2, b"\0"), RSA, der(4, PKCS1))
PUBLIC = der(0x30, RSA, der(3, b"\0", der(0x30, number(7, 128), der(2, b"\1\0\1"))))
EC = der(0x30, der(2, b"\1"), der(4, bytes(32)), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))


def field(x):
    return len(x).to_bytes(4, "big") + x


SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 136)
SSH_PUBLIC = field(b"ssh-ed25519") + field(bytes(range(32)))


def b64(x, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(x).decode()


def token(head, body):
    part = lambda x: b64(json.dumps(x).encode(), True).rstrip("=")
    return f"{part(head)}.{part(body)}.c2lnbmF0dXJl"


def test_confirmed_kinds():
    for data, kind in ((PKCS1, "der"), (PKCS8, "der"), (PUBLIC, "der"), (EC, "der"), (SSH, "ssh"), (SSH_PUBLIC, "ssh")):
        text = f"é key {b64(data)} end"
        assert secrets.confirmed_spans(text) == [(kind, 6, 6 + len(b64(data)))]
    assert [k for k, _, _ in secrets.confirmed_spans(f"x {PKCS1.hex()} y")] == ["der"]
    lines = "\n".join(re.findall(".{1,64}", b64(PKCS8)))
    pem = f"-----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----"
    assert secrets.confirmed_spans("a " + pem) == [("der", 2 + pem.index(lines), 2 + pem.index(lines) + len(lines))]
    jwt = token({"alg": "HS256", "typ": "JWT"}, {"sub": 1})
    assert secrets.confirmed_spans(f"({jwt})") == [("jwt", 1, 1 + len(jwt))]


def test_escaped_lines_and_spaced_token_headers():
    lines = "\\n".join(re.findall(".{1,64}", b64(PKCS8)))
    for end in ("\\n", "\\r\\n", "\\\\n"):
        body = lines.replace("\\n", end)
        text = json.dumps({"a": 1})[:-1] + f', "private_key": "-----BEGIN PRIVATE KEY-----{end}{body}{end}-----END PRIVATE KEY-----{end}"}}'
        assert secrets.confirmed_spans(text) == [("der", text.index(body), text.index(body) + len(body))]
    part = lambda x: b64(x.encode(), True).rstrip("=")
    for gap in ("\n", "\r\n", "\t", " ", ""):
        jwt = f'{part("{" + gap + chr(34) + "alg" + chr(34) + ": " + chr(34) + "HS256" + chr(34) + "}")}.{part("{" + gap + "}")}.c2ln'
        if len(jwt.split(".")[1]) >= 4:
            assert secrets.confirmed_spans(f"({jwt})") == [("jwt", 1, 1 + len(jwt))]


def test_candidates_that_do_not_parse():
    broken = bytearray(PKCS8)
    broken[5] ^= 1
    for text in (b64(bytes(broken)), b64(PKCS8[:-1]), b64(PKCS8 + b"\0"), b64(bytes(200)), "M" * 64, "AAAA" * 20,
                 token({"typ": "JWT"}, {"sub": 1}), token(["alg"], {}), "eyJhbGciOiJI.eyJzdWIi.x", "30" * 40,
                 b64(SSH[:-3]), "-----BEGIN X-----\nAAAA\n-----END X-----"):
        assert secrets.confirmed_spans(text) == [], text


def test_no_prefix_of_a_key_parses():
    for data in (PKCS1, EC, SSH, SSH_PUBLIC):
        for k in range(0, len(data), 3):
            assert not secrets.is_der_key(data[:k]) and (not secrets.is_ssh_key(data[:k]) or data is SSH_PUBLIC)


def brute_base(text):
    spans = []
    for kind, pattern, keep in (
            ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                       r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if keep(m)]
    order = ["assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], order.index(s[1]), s[2])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "PASSWD", "password", "api_key", "APIKEY", " ", "=", ":", "'", '"', "abc12",
                                 "AKIA", "ABCDEFGH", "12345678", "deadbeef", "ſecret", "é", "\n", "x" * 7]), max_size=14))
def test_base_spans(parts):
    assert secrets.joined(secrets.base_spans("".join(parts))) == brute_base("".join(parts))


def test_scan_odd_rows(odd_docs, no_docs):
    rows = {r.doc_id: r for r in secrets.scan(odd_docs).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[1].spans == "" and rows[1].base_sha256 == empty and rows[2].n_hex == 0
    assert secrets.scan(odd_docs).count() == odd_docs.count() and secrets.scan(no_docs).count() == 0


PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div id="cookie-notice">We use</div>'
        '<nav><ul><li><a href=/a>Menu</a></ul></nav><div class="post-{n} content"><article><h1>Title &amp; {n}</h1>'
        '<script>if(a<b){"</p>"}</script><p>First <b>bold</b>\n  para&nbsp;graph.<p>Second <a href="x">link</a> text, long enough '
        'to count.<div class="share">Share</div><section class="comments"><p>A long comment by a reader, longer than it should '
        'be by far, and more of it.</section><form><p>Name</form></article></div><aside>Side</aside><footer>Foot &copy;')


def test_page_text():
    page = html_text.parse(PAGE.replace("{n}", "3"))
    assert html_text.main_text(page, None) == "Title & 3\nFirst bold para graph.\nSecond link text, long enough to count."


def test_text_beside_an_inner_container():
    lead, body, note = "lead " * 40, "body " * 600, "note " * 160
    head = f"<h1>A title</h1><p>{lead}</p>"
    want = f"A title\n{lead.strip()}\n{body.strip()}"
    comments = f'<section class="comments"><p>{note}</p></section>'
    inner = f'<div class="body"><p>{body}</p></div>'
    parse, text = html_text.parse, html_text.main_text
    assert text(parse(f"<body><article>{head}{inner}{comments}</article></body>"), None) == want
    # Also where the host's pages voted for the inner container, or links outweigh the title and lead.
    path = "body>article>div.body"
    refs = f'<div class="refs"><p><a href="x">{"ref " * 90}</a></p></div>'
    assert text(parse(f"<body><article>{head}{inner}{comments}</article></body>"), path) == want
    assert text(parse(f"<body><article>{head}{inner}{refs}</article></body>"), None).startswith(want)
    assert text(parse(f"<body>{head}{inner}<div class='feed'><p>Other.</p></div></body>"), "body>div.body") == want
    sections = "".join(f'<section class="s{k}x"><p>{w * 300}</p></section>' for k, w in (("a", "one "), ("b", "two ")))
    for p in (None, "body>article>section.sax"):
        got = text(parse(f"<body><article>{sections}{comments * 3}</article></body>"), p)
        assert "one" in got and "two" in got and "note" not in got
    parts = f'<div class="post"><div class="lead"><p>{lead}</p></div>{inner}</div>'
    assert text(parse(f"<body>{parts}</body>"), "body>div.post>div.body") == f"{lead.strip()}\n{body.strip()}"
    # A short title beside a long body, and text outside all containers.
    long = "body " * 9000
    assert text(parse(f'<body><div class="p"><h1>T</h1><div class="body"><p>{long}</p></div></div>'), None) == f"T\n{long.strip()}"
    assert text(parse("<h1>T</h1><p>Text.</p><div></div>"), None) == "T\nText."


def test_consensus_path_wins(spark, no_docs):
    odd = ('<html><body><div class="post-9 content"><article><p>Short one.</article></div>'
           '<div class="feed"><p>Much more text than in the article of this page, so that its own best container is this.</div>')
    rows = [(k, f"https://Host.example.com:80/{k}", PAGE.replace("{n}", str(k)), "x") for k in range(5)]
    rows += [(9, "http://u@host.example.com/9", odd, "x"), (10, "http://other.example.com/", odd, None), (11, None, None, "x"),
             (12, "no url", "", "x"), (None, "http://host.example.com", "no markup at all", None), (9, "http://host.example.com/9", odd, "x"),
             (13, "http://third.example.com", "<p>" + "word " * 200_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    got = html_text.extract(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert by[9].text == "Short one." and "Much more" in by[10].text
    assert by[11].text == by[12].text == "" and by[None].text == "no markup at all"
    assert by[13].text == ("word " * 200_000).strip()
    assert html_text.extract(pages.where("false")).count() == 0

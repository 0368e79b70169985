import hashlib

from lakelens.llm import pii


def found(text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.spans(text)[1]]


def test_base_spans():
    text = "é a.b+c@x-y.co.uk, 10.0.0.255 and 256.1.1.1; 4111 1111 1111 1111 or 4111111111111112 +1 (555) 010-9999."
    assert found(text) == [("email", "a.b+c@x-y.co.uk"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"),
                           ("phone", "+1 (555) 010-9999")]
    assert pii.spans(text)[0] == pii.spans(text)[1]


def test_disguises_map_back_to_the_source():
    for text, span in [("mail john [at] site [dot] com now", "john [at] site [dot] com"),
                       ("to john at site dot org.", "john at site dot org"), ("j.d(at)mail8.example.com", "j.d(at)mail8.example.com"),
                       ("jоhn@ехample.com", "jоhn@ехample.com"), ("x user＠host．com y", "user＠host．com")]:
        assert ("email", span) in found(text)
    assert ("phone", "plus one two three four five six seven eight nine zero one") in found(
        "call plus one two three four five six seven eight nine zero one today")
    assert ("card", "４１１１ １１１１ １１１１ １１１１") in found("no ４１１１ １１１１ １１１１ １１１１.")


def test_whole_identifier_is_added_beside_a_base_part():
    for text, part, whole in [("to jоhn@example.com now", "hn@example.com", "jоhn@example.com"),
                              ("to john@example.cоm now", "john@example.c", "john@example.cоm"),
                              ("to ann@mail.example dot com now", "ann@mail.example", "ann@mail.example dot com")]:
        base, every = pii.spans(text)
        assert [text[a:b] for _, a, b in base] == [part]
        assert found(text) == sorted([("email", part), ("email", whole)], key=lambda x: text.index(x[1]))
        assert set(base) <= set(every) and len(every) == 2


def test_plain_prose_has_no_spans():
    for text in ("", None, "look at one dot", "at five or six, seven or eight people met", "été ñandú ßtraße " * 50):
        assert pii.spans(text) == ([], [])


def test_query_columns(spark, edge, empty, docs):
    for df in (edge, docs):
        rows = {(str(r["doc_id"]), r["base_sha256"], r["spans"], r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"])
                for r in pii.personal_data(df).collect()}
        want = set()
        for r in df.collect():
            base, every = pii.spans(r["text"])
            want.add((str(r["doc_id"]), hashlib.sha256(pii.written(base).encode()).hexdigest(), pii.written(every), len(base)))
        assert rows == want
    assert pii.personal_data(empty).count() == 0


def test_base_spans_equal_plain_regex_on_random_texts():
    """Independent of ``detect``: finditer of the contract's patterns plus its checks."""
    import random
    rng = random.Random(3)
    pieces = ["@", "@", ".", ".", "-", "+", " ", " ", "a", "b1", "1", "12", "255", "256", "007", "x.y", "é", "(", ")", "_", "%",
              "4111", "1111", "10.0.0.1", "a@b.c", "+1 555 010 9999", "\n", "１"]

    def plain(text):
        out = [(0, *m.span()) for m in pii.EMAIL.finditer(text)]
        out += [(1, *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in pii.CARD.finditer(text):
            d = [int(c) for c in m[0] if c.isdigit()]
            check = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
            if 14 <= len(d) <= 19 and check % 10 == 0:
                out.append((2, *m.span()))
        out += [(3, *m.span()) for m in pii.PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
        return sorted(out, key=lambda x: (x[1], x[0]))

    hits = 0
    for _ in range(10_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 24)))
        want = plain(text)
        hits += len(want)
        assert pii.spans(text)[0] == want, text
    assert hits > 3000


def test_long_unbroken_texts_take_linear_time():
    import time
    n = 1_000_000
    for text in ("." + "1" * n, "a" * n + " x@y.zz", "a@" * (n // 2), "1." * (n // 2), "a." * (n // 2) + "@", " " * n + "[at]",
                 "[" * n, "a dot " * (n // 6), "one " * (n // 4), "+1" + "(" * n, "é" + " " * n, "x at " * (n // 5),
                 "a" * n + "@" + "b" * n, "​" * (n // 10), "a@b.cc " * (n // 7) + "é", " dot" * (n // 4) + " a@b dot cc"):
        t = time.process_time()
        pii.spans(text)
        assert time.process_time() - t < 6, text[:20]
    for text in ("." + "1" * n, "a" * n + " x@y.zz"):
        t = time.process_time()
        pii.spans(text)
        assert time.process_time() - t < 1


def test_whole_spelled_addresses():
    for text, kind, span in [
            ("write john dot doe at example dot com today", "email", "john dot doe at example dot com"),
            ("to ann@mail dot example dot com now", "email", "ann@mail dot example dot com"),
            ("ask ann at example.com or call", "email", "ann at example.com"),
            ("host one nine two dot one six eight dot zero dot one is up", "ip",
             "one nine two dot one six eight dot zero dot one"),
            ("j dot r [at] a-very-long-host-name-that-goes-on-and-on-and-on-and-on-and-on-and-on-and-on.example [dot] org", "email",
             "j dot r [at] a-very-long-host-name-that-goes-on-and-on-and-on-and-on-and-on-and-on-and-on.example [dot] org")]:
        assert (kind, span) in found(text), (text, found(text))
    for text in ("we look at fig.two and at table.three", "meet at noon. then go"):
        assert found(text) == []

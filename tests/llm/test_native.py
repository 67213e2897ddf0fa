"""URL filters, licence scan and pseudonyms on small fixtures."""

import datetime
import hashlib
import re

from pyspark.sql import functions as F

from firnline.llm import licenses, pii, url_filters


def test_captures_meet_the_entries_active_then(spark):
    entries = spark.createDataFrame([
        ("a", "bad.com", "2024-01-10", "add"), ("a", "bad.com", "2024-01-20", "remove"), ("a", "bad.com", "2024-02-01", "add"),
        ("a", "bad.com", "2024-02-05", "add"), ("b", "x.bad.com", "2024-01-15", "add"), ("b", "x.bad.com", "2024-01-15", "remove"),
        ("b", None, "2024-01-01", "add"), ("c", "ok.org", "2024-01-01", "remove"), ("c", "ok.org", None, "add"),
    ], "list string, pattern string, day string, action string")
    captures = spark.createDataFrame([
        (1, "http://bad.com/p", "2024-01-09"), (2, "https://X.bad.com:80/?q", "2024-01-16"), (3, "http://u:p@y.bad.com", "2024-01-20"),
        (4, "http://bad.com", "2024-03-01"), (4, "http://bad.com", "2024-03-01"), (5, None, "2024-03-01"), (6, "no url", "2024-03-01"),
        (7, "http://bad.com", None), (None, "http://notbad.com", "2024-03-01"), (8, "http://ok.org", "2024-03-01"),
        (9, "http://" + "a." * 5000 + "bad.com", "2024-03-01"),
    ], "page_id long, url string, fetched string").withColumn("pattern", F.lit("clash")).withColumn("day", F.lit(1))
    got = sorted(((r.page_id, r.n_active, r.lists, r.blocked) for r in url_filters.url_verdicts(captures, entries).collect()), key=str)
    assert got == sorted([
        (1, 0, "", False), (2, 2, "a,b", True), (3, 0, "", False), (4, 1, "a", True), (4, 1, "a", True), (5, 0, "", False),
        (6, 0, "", False), (7, 0, "", False), (None, 0, "", False), (8, 0, "", False), (9, 0, "", False)], key=str)
    assert url_filters.url_verdicts(captures.where("false"), entries).collect() == []
    assert url_filters.url_verdicts(captures, entries.where("false")).where("blocked").collect() == []


def test_entries_of_any_length_and_spelling_cover_what_is_below(spark):
    entries = spark.createDataFrame([
        ("top", "zip", "2024-01-01", "add"), ("mixed", "Bad.COM.", "2024-01-01", "add"), ("mixed", "bad.com", "2024-02-01", "remove"),
        ("inner", "intranet", "2024-01-01", "add"),
    ], "list string, pattern string, day string, action string")
    captures = spark.createDataFrame([
        (1, "http://a.b.zip/", "2024-01-05"), (2, "http://zip", "2024-01-05"), (3, "http://x.bad.com", "2024-01-05"), (4, "http://bad.com.", "2024-01-05"),
        (5, "http://bad.com", "2024-02-05"), (6, "http://intranet/", "2024-01-05"), (7, "http://notzip", "2024-01-05"), (8, "http://zip.org", "2024-01-05"),
    ], "page_id long, url string, fetched string")
    got = {r.page_id: r.lists for r in url_filters.url_verdicts(captures, entries).collect()}
    assert got == {1: "top", 2: "top", 3: "mixed", 4: "mixed", 5: "", 6: "inner", 7: "", 8: ""}


def test_licences_need_their_sentences_in_order(spark):
    s = licenses.SENTENCES
    wrapped = (s["mit_grant"].replace(" to deal", "\nto deal") + ":\n\n" + s["mit_notice"] + ".")
    rows = [
        (1, "Prose.\nReleased under the MIT License.\nMore"), (2, wrapped), (3, s["mit_notice"] + ". " + s["mit_grant"]),
        (4, "title\n" + s["apache_licensed"] + ".\n" + s["gpl3_work"] + "."), (5, None), (6, ""), (6, "Licensed under cc by-nc 4.0!"),
        (7, "This license is fine."), (None, "; ".join([s["bsd_grant"], "x", s["bsd_source"], s["bsd_binary"], s["bsd_names"]])),
        (8, "w " * 100_000 + ". " + s["mpl"] + ". "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit("clash"))
    got = sorted(((r.doc_id, r.licenses) for r in licenses.scan_licenses(docs).collect()), key=str)
    assert got == sorted([(1, "MIT"), (2, "MIT"), (3, ""), (4, "Apache-2.0,GPL-3.0"), (5, ""), (6, ""), (6, "CC-BY-NC-4.0"), (7, ""),
                          (None, "BSD-2-Clause,BSD-3-Clause"), (8, "MPL-2.0")], key=str)
    assert licenses.scan_licenses(docs.where("false")).collect() == []


def luhn(d):
    return sum((lambda v: v - 9 if v > 9 else v)(int(c) * (2 if i % 2 else 1)) for i, c in enumerate(reversed(d))) % 10 == 0


def feistel(key, left, right, a, b):
    for i in range(pii.ROUNDS):
        f = lambda v, m: int(hashlib.sha256(f"{key}:{i}:{v}".encode()).hexdigest()[:15], 16) % m
        if i % 2 == 0:
            left = (left + f(right, a)) % a
        else:
            right = (right + f(left, b)) % b
    return left, right


def digits(key, d):
    h = len(d) // 2
    a, b = feistel(f"{key}/{len(d)}", int(d[:h]), int(d[h:]), 10**h, 10 ** (len(d) - h))
    return str(a).zfill(h) + str(b).zfill(len(d) - h)


def test_pseudonyms_keep_format_and_links(spark):
    rows = [
        (1, "call +1 (386) 555-1832 or 386.555.1832, card 4918187128635271 é"), (2, "again (386) 555-1832; card 4918 1871 2863 5271."),
        (3, "not valid: 4918187128635272, 300.1.1.1, 2023-02-30, 666-12-1234"), (4, "10.20.30.40 on 2023-02-28 and 1850-03-01, 123-45-6789"),
        (5, None), (6, ""), (6, "mail kfslg.71@mail0.example.com"), (None, "KFSLG.71@mail0.example.com 2023-02-28"), (7, "7" * 50_000 + " a@b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hits", F.lit("clash")).withColumn("found", F.lit(1))
    got = pii.pseudonymised(docs, "k").collect()
    by = {(r.doc_id, bool(r.text)): r for r in got}
    phone = digits("kphone", "3865551832")
    card = digits("kcard", "491818712863527")
    card += next(c for c in "0123456789" if luhn(card + c))
    assert by[1, True].text == f"call +1 ({phone[:3]}) {phone[3:6]}-{phone[6:]} or {phone[:3]}.{phone[3:6]}.{phone[6:]}, card {card} é"
    assert by[2, True].text == f"again ({phone[:3]}) {phone[3:6]}-{phone[6:]}; card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}."
    assert by[3, True].text == rows[2][1] and by[3, True].found == ""
    left, right = feistel("kip", 10 * 256 + 20, 30 * 256 + 40, 65536, 65536)
    n = (datetime.date(2023, 2, 28) - datetime.date(1900, 1, 1)).days
    a, b = feistel("kdate", n // 270, n % 270, 270, 270)
    day = datetime.date(1900, 1, 1) + datetime.timedelta(days=a * 270 + b)
    ip, new, old, ssn = by[4, True].found.split("|")
    assert (ip, new) == (f"{left // 256}.{left % 256}.{right // 256}.{right % 256}", day.isoformat())
    assert old[:5] == "1850-" and datetime.date.fromisoformat(old) and re.fullmatch(r"\d{3}-\d\d-\d{4}", ssn)
    assert by[None, True].found.split("|")[1] == new
    assert by[6, True].found.split("@")[1] == "mail0.example.com" and by[None, True].found.split("|")[0].lower() == by[6, True].found
    assert (by[5, False].text, by[6, False].text, by[7, True].n_card) == (None, "", 0)
    assert len(got) == len(rows) and by[7, True].text == rows[8][1]
    assert pii.pseudonymised(docs.where("false"), "k").collect() == []


def test_permutation_has_no_collisions(spark):
    frame = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = [r.p for r in frame.select(pii.permuted_digits(F.lit("k"), F.col("d")).alias("p")).collect()]
    assert len(set(out)) == 1000 and all(len(p) == 3 for p in out)


def test_numbers_are_whole_runs_of_digits(spark):
    """Pieces of longer runs are no values, wherever they are cut; whole ones beside letters and signs are."""
    pieces = [
        "1234.1.2.3", "1.2.3.4.5", "10.20.30.400", "20240115-2024-01-155", "12024-01-15", "99999212.555.12345", "1123-45-6789", "123-45-67890",
        "4918 1871 2863 52711", "14918 1871 2863 5271", "0" * 12,
    ]
    whole = {
        "10.20.30.40.": "ip", "v:10.20.30.40": "ip", "2024-01-15T10": "date", "2024-01-15-2024-01-16": "date", "1-386-555-1832": "phone", "x123-45-6789y": "ssn",
        "3782 822463 10005": "card", "378282246310005": "card",
    }
    rows = [(i, f"a {t} b") for i, t in enumerate([*pieces, *whole])]
    got = {r.doc_id: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    for i, text in rows[:len(pieces)]:
        assert (got[i].text, got[i].found) == (text, ""), text
    for (i, text), kind in zip(rows[len(pieces):], whole.values()):
        r = got[i]
        assert r[f"n_{kind}"] >= 1 and sum(r[f"n_{k}"] for k in pii.KINDS) == r[f"n_{kind}"], text
        assert r.text != text and re.sub("[0-9]", "0", r.text).count("0") >= 4, text
    amex = got[len(rows) - 2].found
    assert re.fullmatch(r"\d{4} \d{6} \d{5}", amex) and luhn(amex.replace(" ", "")) and amex.replace(" ", "") == got[len(rows) - 1].found


def test_hosts_as_browsers_read_them(spark):
    want = {
        "http://a@b@bad.com/": "bad.com", "http://bad.com\\@good.org/": "bad.com", "http://[2001:DB8::1]:80/x": "[2001:db8::1]",
        "http://ex%61mple.com": "example.com", "//bad.com/x": "bad.com", "https:bad.com": "bad.com", "HTTP:\\\\bad.com\\x": "bad.com", "http:///bad.com": "bad.com",
        " \x01http://bad.com ": "bad.com", "ht\ntp://b\tad.com": "bad.com", "http://u:p@bad.com:8080?q@x": "bad.com", "http://bad.com#@good.org": "bad.com",
        "http://bad\u3002com/": "bad.com", "http://bad%2Ecom.": "bad.com", "http://bad%2Fgood.com": "", "http://b%zzad.com": "", "http://a b.com/": "",
        "http://[bad.com]/": "", "http://[bad.com": "", "mailto:a@bad.com": "", "foo://Bad.com\\x": "", "foo://bad.com/x": "bad.com", "bad.com/x": "", "/bad.com": "", "": "",
        "http://": "", "http://@": "", "http://a+b.com": "a+b.com", "http://1.2.3.4/": "1.2.3.4", "http://" + "a" * 254: "",
    }
    rows = spark.createDataFrame([(u,) for u in want], "u string").select("u", url_filters.host_of(F.col("u")).alias("h")).collect()
    assert {r.u: r.h for r in rows} == want


def test_verdicts_against_all_entries_by_hand(spark):
    """Random entries and captures against a loop over all entries."""
    import random

    rng = random.Random(3)
    names = ["com", "bad.com", "x.bad.com", "y.x.bad.com", "ok.org", "1.2.3.4", "3.4", "[::1]", "zip"]
    day = lambda: f"2024-01-{rng.randint(1, 9):02}"
    entries = [(rng.choice("ab"), rng.choice(names), day(), rng.choice(["add", "remove"])) for _ in range(60)]
    captures = [(i, f"http://{rng.choice(names)}/p", day()) for i in range(200)]

    def active(entry_list, pattern, on):
        seen = {d: [a for l, p, d2, a in entries if (l, p, d2) == (entry_list, pattern, d)] for _, _, d, _ in entries if d <= on}
        last = max((d for d, acts in seen.items() if acts), default=None)
        return last is not None and "add" in seen[last]

    def covers(pattern, host):
        return pattern == host or (host[0] not in "[1" and host.endswith("." + pattern))

    want = {}
    for i, url, on in captures:
        host = url[7:-2]
        hits = {(l, p) for l, p, _, _ in entries if covers(p, host) and active(l, p, on)}
        want[i] = (len(hits), ",".join(sorted({l for l, _ in hits})))
    got = url_filters.url_verdicts(
        spark.createDataFrame(captures, "page_id long, url string, fetched string"), spark.createDataFrame(entries, "list string, pattern string, day string, action string")
    ).collect()
    assert {r.page_id: (r.n_active, r.lists) for r in got} == want

"""URL, page, site, address and admission rules on literal rows."""

import pytest
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.functions import addresses, hosts
from urlsift.functions import url as U
from urlsift.operators import admission, crawl
from urlsift.operators.elements import scan_html
from urlsift.operators.page_features import page_features


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v")).alias("r")).first()["r"]


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "id int, label int")
    with pytest.raises(C.ContractError, match="missing columns"):
        C.require_columns(df, ["id", "zeta", "alpha"])
    with pytest.raises(C.ContractError, match="1 row"):
        C.check_labels(df)
    with pytest.raises(C.ContractError, match="3"):
        C.check_labels(df.filter("label is not null"))


@pytest.mark.parametrize(
    "url,dom,tld,subs,ip",
    [
        ("https://user:pw@www.a.b.co.uk:8080/x?y#z", "user:pw@www.a.b.co.uk:8080", "uk:8080", 3, 0),
        ("http://192.168.1.300/x", "192.168.1.300", "300", 2, 0),
        ("http://192.168.1.30/x", "192.168.1.30", "30", 2, 1),
        ("example.com/path", "", None, 0, 0),
        ("//cdn.test/x", "cdn.test", "test", 0, 0),
        ("mailto:a@b.c", "", None, 0, 0),
    ],
)
def test_domain_parts(spark, url, dom, tld, subs, ip):
    row = spark.createDataFrame([(url,)], "u string").select(U.domain("u").alias("d")).select(
        "d", U.tld("d").alias("t"), U.subdomain_count("d").alias("s"), U.is_domain_ip("d").alias("i")
    ).first()
    assert tuple(row) == (dom, tld, subs, ip)


@pytest.mark.parametrize(
    "url,flag",
    [("http://a-b-c-d-e.test/", 1), ("http://abc1.test", 1), ("abcd", 1), ("site.example", 1),
     ("http://plain.test/page/x", 0), ("://..", 1), ("", 1), (None, 0)],
)
def test_obfuscation(spark, url, flag):
    assert one(spark, url, U.has_obfuscation) == flag


def test_title_scores_follow_the_fold(spark):
    def fold(title, text):
        score, share = 0.0, 100 / len(text) if text else 0
        for word in title.split(" "):
            if word in text:
                score += share * len(word)
                text = text.replace(word, "")
                if score > 99.9:
                    score = 100
        return score

    cases = [("my shop here", "www.shop.my.com"), ("a  a aa", "aaa.a.net"), ("x", "x.com"), ("none", "q.r.s"), ("", "abc.de")]
    df = spark.createDataFrame(cases, "t string, d string")
    got = [r[0] for r in df.select(U.domain_title_score("t", "d")).collect()]
    want = [fold(t, ".".join(p for p in d.split(".")[:-1] if p != "www")) for t, d in cases]
    assert got == pytest.approx(want)


@pytest.mark.parametrize(
    "host,site",
    [("www.a.example.com", "example.com"), ("login.x.co.uk", "x.co.uk"), ("co.uk", "co.uk"), ("a.b.test", "a.b.test"),
     ("10.0.0.1", "10.0.0.1"), ("a.b.c.ck", "b.c.ck"), ("x.www.ck", "www.ck"), ("EXAMPLE.com", "example.com")],
)
def test_sites(spark, host, site):
    assert one(spark, host, hosts.site_of_host) == site


PAGE = """<html><head><title> Sign &amp; in </title><meta name="robots" content="noindex">
<meta name="viewport" content="WIDTH=device-width"><link rel="Shortcut Icon" href="/f.ico"><link rel=stylesheet href=s.css>
<meta http-equiv=Refresh content="0;URL='https://other.org/x'"><style>a{}</style><!-- <img> --></head>
<body onload="window.open ('x')"><script>alert(1); var s="<iframe>";</script><form action="https://evil.test/p"><button>Go</button>
<input type=HIDDEN><input type="password"></form><button>out</button><img src=a><img src=b><iframe></iframe>
<a href="/in">i</a><a href="https://shop.example.com/x">s</a><a href="https://m.facebook.com/">f</a><a href="#">e</a><a>n</a>
<a href="mailto:a@b.c">m</a><p>Pay your invoice, display only</p><footer>Copyright us</footer></body>"""


def test_page_features(spark):
    df = spark.createDataFrame([(1, "https://www.example.com/a", PAGE), (2, "https://x.org", None), (3, "https://x.org", "<a <b <form")],
                               "page_id long, url string, html string")
    rows = {r["page_id"]: r.asDict() for r in page_features(df).collect()}
    want = {
        "Title": "Sign & in", "HasTitle": 1, "HasFavicon": 1, "Robots": 0, "IsResponsive": 1, "NoOfURLRedirect": 1,
        "NoOfSelfRedirect": 0, "HasDescription": 0, "NoOfPopup": 2, "NoOfiFrame": 1, "HasExternalFormSubmit": 1,
        "HasSocialNet": 1, "HasSubmitButton": 1, "HasHiddenFields": 1, "HasPasswordField": 1, "Bank": 0, "Pay": 1,
        "Crypto": 0, "HasCopyrightInfo": 1, "NoOfImage": 2, "NoOfCSS": 2, "NoOfJS": 1, "NoOfSelfRef": 2,
        "NoOfEmptyRef": 2, "NoOfExternalRef": 1, "LineOfCode": 7,
    }
    assert {k: rows[1][k] for k in want} == want
    assert all(v is None for k, v in rows[2].items() if k != "page_id")
    assert rows[3]["NoOfImage"] == 0
    lost = page_features(df, demoted=("Pay", "NoOfImage")).filter("page_id = 1").first()
    assert lost["Pay"] is None and lost["NoOfImage"] is None and lost["Bank"] == 0


@pytest.mark.parametrize("html", ["", "<", "<!", "<!--", "<a href='x", "</p></div>", "<![CDATA[x", "<script>", "\x00<p>"])
def test_scan_never_raises(html):
    assert set(scan_html(html)) == {"title", "text", "footer", "elements"}


REJECTED = [
    ("file:///etc/passwd", "scheme_not_allowed"), ("ftp://example.com/x", "scheme_not_allowed"),
    ("javascript:alert(1)", "scheme_not_allowed"), ("", "empty_url"), (None, "empty_url"), ("http://", "missing_host"),
    ("http://u:p@example.com/", "credentials_in_url"), ("http://example.com@evil.test/", "credentials_in_url"),
    ("http://example.com:22/", "port_not_allowed"), ("http://example.com:99999/", "invalid_port"),
    ("http://blocked.test/", "host_denied"), ("http://deep.sub.blocked.test/", "host_denied"),
    ("http://notblocked.test/", None), ("https://example.com:443/a?b=c", None), ("http://example.com:80/", None),
    ("http://" + "a" * 2100, "url_too_long"), ("http://[::1", "unparseable_url"),
]


def test_admission(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(REJECTED)], "i int, u string")
    got = [r[0] for r in df.orderBy("i").select(admission.admission_reason(F.col("u"), ["blocked.test"])).collect()]
    assert got == [r for _, r in REJECTED]


ADDRESSES = [
    ("127.0.0.1", "loopback_address"), ("::1", "loopback_address"), ("10.0.0.5", "private_address"),
    ("169.254.169.254", "private_address"), ("100.64.0.1", "cgnat_address"), ("0.0.0.0", "unspecified_address"),
    ("224.0.0.1", "multicast_address"), ("::ffff:127.0.0.1", "loopback_address"), ("::ffff:8.8.8.8", "ipv4_mapped"),
    ("192.0.0.9", "ietf_protocol_assignment"), ("8.8.8.8", None), ("2606:4700::1111", None), ("::", "unspecified_address"),
    ("fe80::1", "private_address"), ("fec0::1", "site_local_address"), ("2001:db8:0:0:0:0:0:1", "private_address"),
    ("4000::1", "reserved_address"), ("1.2.3.256", None), ("host.test", None), ("1::2::3", None),
]


def test_addresses(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ADDRESSES)], "i int, a string")
    got = [r[0] for r in df.orderBy("i").select(addresses.address_reason(F.col("a"))).collect()]
    assert got == [r for _, r in ADDRESSES]


@pytest.mark.parametrize(
    "text,allowed",
    [("User-agent: *\nDisallow: /", 0), ("User-agent: *\nDisallow: /admin", 1), ("User-agent: b\nDisallow: /", 1), ("", 1),
     ("User-agent: *\nDisallow: /a\n\nUser-agent: x\nDisallow: /", 1), ("# c\nUSER-AGENT : * # all\n disallow : / ", 0), (None, None)],
)
def test_robots(spark, text, allowed):
    assert one(spark, text, crawl.robots_allowed) == allowed


def test_long_deny_table_equals_short_list(spark):
    rows = spark.createDataFrame([(1, "a.b.bad.org"), (2, "good.org"), (3, "bad.org"), (4, "verybad.org")], "id int, host string")
    deny = spark.createDataFrame([("bad.org",)], "host string")
    by_table = {r[0] for r in admission.denied_rows(rows, deny, "id").collect()}
    by_list = {r[0] for r in rows.filter(admission.is_denied(F.col("host"), ["bad.org"])).select("id").collect()}
    assert by_table == by_list == {1, 3}

"""Fixed values the results depend on: word lists, markers, patterns, limits."""

KEYWORD_LIST_VERSION = "1"
SCHEMA_VERSION = 1

# Social sites, compared by registrable domain.
SOCIAL_DOMAINS = (
    "facebook.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "youtube.com",
    "pinterest.com", "tiktok.com", "t.me", "telegram.org", "whatsapp.com", "reddit.com",
    "github.com", "vk.com", "weibo.com",
)

# Whole-word terms of the three keyword features.
BANK_TERMS = (
    "bank", "banking", "banco", "netbanking", "account", "savings", "checking", "ifsc", "iban",
    "swift", "credit union", "debit card",
)
PAY_TERMS = (
    "pay", "payment", "paypal", "checkout", "invoice", "billing", "visa", "mastercard", "amex",
    "stripe", "payoneer", "western union", "transfer", "remit",
)
CRYPTO_TERMS = (
    "crypto", "bitcoin", "btc", "ethereum", "eth", "wallet", "blockchain", "binance",
    "coinbase", "metamask", "ledger", "trezor", "seed phrase", "usdt", "nft",
)

# References that lead nowhere (compared trimmed, lower case).
EMPTY_REFS = (
    "", "#", "javascript:void(0)", "javascript:void(0);", "javascript:;", "about:blank",
)

# Element and attribute pairs that count as a reference.
ANCHOR_REFS = (("a", "href"),)
RESOURCE_REFS = (
    ("a", "href"), ("link", "href"), ("script", "src"), ("img", "src"), ("iframe", "src"),
    ("form", "action"), ("source", "src"),
)
REF_SCOPES = {"anchor": ANCHOR_REFS, "all_resources": RESOURCE_REFS}

# Rel tokens of an icon link.
ICON_RELS = ("icon", "shortcut", "apple-touch-icon", "mask-icon")

# Script calls counted as popups, and the copyright notice.
POPUP_PATTERNS = (
    r"window\.open\s*\(", r"\balert\s*\(", r"\bconfirm\s*\(", r"\bprompt\s*\(",
)
COPYRIGHT_PATTERN = r"©|&copy;|\bcopyright\b|all rights reserved"
META_REFRESH_PATTERN = r"url\s*=\s*['\"]?([^'\";]+)"

# Phrases of an interstitial served instead of the page.
CHALLENGE_MARKERS = (
    "just a moment", "checking your browser", "enable javascript and cookies to continue",
    "cf-browser-verification", "cf_chl_opt", "attention required! | cloudflare",
    "ddos protection by", "please verify you are a human", "captcha-delivery.com", "px-captcha",
    "incapsula incident id", "access denied",
)

# Page tails searched for a copyright notice; challenge head.
TEXT_TAIL = 1500
RAW_TAIL = 2000
CHALLENGE_HEAD = 4096

# Crawl policy and outcome names.
MAX_URL_LENGTH = 2048
ALLOWED_SCHEMES = ("http", "https")
DEFAULT_PORTS = {"http": 80, "https": 443}
ALLOWED_PORTS = (80, 443)
ALLOWED_TYPES = ("text/html", "application/xhtml+xml", "text/plain")
MAX_BYTES = 2 * 1024 * 1024
MAX_REDIRECTS = 3
REDIRECT_STATUS = (301, 302, 303, 307, 308)
OUTCOMES = (
    "ok", "blocked_by_policy", "dns_fail", "timeout", "too_large", "unsupported_type",
    "http_error", "challenge_detected", "disabled", "rate_limited",
)

# Serving limits and thresholds.
RATE_PER_SESSION = 10
RATE_WINDOW_SECONDS = 300
BATCH_MAX_URLS = 25
BATCH_MAX_ROWS = 5000
COVERAGE_MIN = 0.60
NUMERIC_SKEW_LIMIT = 3.0
TLD_SKEW_LIMIT = 1.0
KNN_REFERENCE_ROWS = 10_000
KNN_K = 20
KNN_K_LEAKY = 6
BINARY_GATE = 0.85
COUNT_GATE = 0.70
MIN_COMPARABLE = 5

# IPv4 blocks by reason, most specific reason first; a block named
# in IPV4_PUBLIC is carved out of the private ones.
IPV4_BLOCKS = (
    ("unspecified_address", ("0.0.0.0/32",)),
    ("loopback_address", ("127.0.0.0/8",)),
    ("private_address", (
        "0.0.0.0/8", "10.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24",
        "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24",
        "203.0.113.0/24", "240.0.0.0/4",
    )),
    ("multicast_address", ("224.0.0.0/4",)),
    ("cgnat_address", ("100.64.0.0/10",)),
    ("ietf_protocol_assignment", ("192.0.0.0/24",)),
)
IPV4_PUBLIC = ("192.0.0.9/32", "192.0.0.10/32")

# IPv6 blocks by reason, in the same manner.
IPV6_BLOCKS = (
    ("unspecified_address", ("::/128",)),
    ("loopback_address", ("::1/128",)),
    ("private_address", (
        "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "3fff::/20",
        "fc00::/7", "fe80::/10",
    )),
    ("multicast_address", ("ff00::/8",)),
    ("reserved_address", (
        "::/8", "100::/8", "200::/7", "400::/6", "800::/5", "1000::/4", "4000::/3", "6000::/3",
        "8000::/3", "a000::/3", "c000::/3", "e000::/4", "f000::/5", "f800::/6", "fe00::/9",
    )),
    ("site_local_address", ("fec0::/10",)),
)
IPV6_PUBLIC = (
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28",
    "2001:30::/28",
)

# A small public-suffix table written from public knowledge.
# Callers pass a larger one where they have it. "*." and "!" rules are allowed.
SUFFIX_RULES = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "co", "me",
    "app", "dev", "xyz", "online", "site", "shop", "top", "club", "tv", "cc", "ai", "us", "ca",
    "mx", "br", "com.br", "org.br", "net.br", "ar", "com.ar", "uk", "co.uk", "org.uk", "ac.uk",
    "gov.uk", "me.uk", "net.uk", "ie", "fr", "de", "es", "com.es", "pt", "it", "nl", "be", "lu",
    "ch", "at", "pl", "com.pl", "cz", "sk", "hu", "ro", "bg", "gr", "se", "no", "fi", "dk", "is",
    "ru", "com.ru", "ua", "com.ua", "by", "tr", "com.tr", "il", "co.il", "in", "co.in", "org.in",
    "net.in", "cn", "com.cn", "net.cn", "org.cn", "hk", "com.hk", "tw", "com.tw", "jp", "co.jp",
    "ne.jp", "or.jp", "ac.jp", "kr", "co.kr", "sg", "com.sg", "my", "com.my", "th", "co.th",
    "vn", "com.vn", "ph", "com.ph", "id", "co.id", "go.id", "ac.id", "au", "com.au", "net.au",
    "org.au", "nz", "co.nz", "org.nz", "za", "co.za", "ng", "com.ng", "ke", "co.ke", "eg", "eu",
    "asia", "*.ck", "!www.ck",
)

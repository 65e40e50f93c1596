"""Pattern lists compiled to Java regexes behave like Python's ``re`` on text."""

import re

from trafficlens.functions.regex import matches_any

CASES = [
    # (text, pattern, ignore_case)
    ("/ÉTC/passwd", "étc", True),       # Unicode case folding
    ("id=٣", r"=\d", True),            # Unicode digit
    ("naïve", r"^\w+$", False),         # Unicode word character
    ("a\u2003b", r"a\sb", False),      # Unicode space (em space)
    ("line\nnext", r"line$", False),    # only \n ends a line for $ (UNIX_LINES)
    ("abc\r", r"abc$", False),          # \r is not a line end in Python
    ("wp-login.php", "WP-LOGIN", True),
    ("wp-login.php", "WP-LOGIN", False),
]


def test_matches_any_like_python_re(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, s string")
    exprs = [matches_any("s", [p], ignore_case=ic).alias(f"m{i}") for i, (_, p, ic) in enumerate(CASES)]
    got = {r["i"]: r for r in df.select("i", *exprs).collect()}
    for i, (text, pat, ic) in enumerate(CASES):
        want = bool(re.search(pat, text, re.IGNORECASE if ic else 0))
        assert got[i][f"m{i}"] == want, (text, pat, ic)


def test_old_browser_presets(spark):
    """Q9: the reference presets over-match modern browsers; the corrected ones do not."""
    from trafficlens.functions import features as X

    uas = {
        "chrome120": "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
                     "Chrome/120.0.0.0 Safari/537.36",
        "firefox121": "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
        "safari17": "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
                    "Version/17.0 Safari/605.1.15",
        "msie6": "Mozilla/4.0 (compatible; MSIE 6.0; Windows NT 5.1)",
        "firefox3": "Mozilla/5.0 (Windows; U; Windows NT 5.1; en-US; rv:1.9.0.1) Gecko/2008070208 Firefox/3.0.1",
        "safari5": "Mozilla/5.0 (Macintosh; U; Intel Mac OS X 10_6_8; en-us) AppleWebKit/534.50 (KHTML, like Gecko) "
                   "Version/5.1 Safari/534.50",
        "ios4": "Mozilla/5.0 (iPhone; U; CPU iPhone OS 4_0 like Mac OS X; en-us) AppleWebKit/532.9 (KHTML, like Gecko) "
                "Version/4.0.5 Mobile/8A293 Safari/6531.22.7",
    }
    df = spark.createDataFrame(list(uas.items()), "k string, user_agent string")
    cols = {f"{prof}_{preset}": (X.ua_flags_T([], old_browser=preset) if prof == "train"
                                 else X.ua_flags_S([], old_browser=preset))["is_old_browser"]
            for prof in ("train", "serve") for preset in ("reference", "corrected")}
    got = {r["k"]: r for r in df.select("k", *[v.alias(n) for n, v in cols.items()]).collect()}
    # Reference behaviour (kept as the default): modern UAs are flagged.
    assert got["chrome120"]["train_reference"] and got["firefox121"]["train_reference"]
    assert got["safari17"]["serve_reference"] and got["chrome120"]["serve_reference"]
    # Corrected presets: modern UAs are not old, old ones are.
    for k in ("chrome120", "firefox121", "safari17"):
        assert not got[k]["train_corrected"] and not got[k]["serve_corrected"], k
    for k in ("msie6", "firefox3", "safari5", "ios4"):
        assert got[k]["train_corrected"] and got[k]["serve_corrected"], k

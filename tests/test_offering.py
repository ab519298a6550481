"""Cover cases, and random covers against a brute-force reading with Python's ``re``."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from greenshoe import fixed_values as V
from greenshoe.plans import terms as T

NBSP = "\xa0"

# cover -> (low, high, shares); no-break spaces count as spaces.
COVERS = {
    "This is an initial public offering of Acme. We are offering 11,000,000 ordinary shares. "
    "The initial public offering price per share is $16.00": (16, 16, 11000000),
    "We expect a price between $14.00 and $16.00 per share. 2,000,000 Shares": (14, 16, 2000000),
    "Per Share $ 1,250.00": (1, 1, None),
    "price range of $600 to $700": (None, None, None),
    "5,000 shares of common stock": (None, None, None),
    "1,500,000 American Depositary Shares": (None, None, 1500000),
    "2,273,000 ADSs": (None, None, 2273000),
    "We are offering, on a firm commitment basis, 1,050,000 Ordinary Shares": (None, None, 1050000),
    "We are offering on a firm commitment basis, 1,050,000 Ordinary Shares": (None, None, 1050000),
    "$16.00": (16, 16, None),
    "cover $16.00 text": (None, None, None),
    "11,000,000 Shares LOAR": (None, None, 11000000),
    f"Per{NBSP}Share{NBSP}$ 16.00 1,600,000{NBSP}Shares": (16, 16, 1600000),
    "offering price of $10.00 per unit": (10, 10, None),
    "public offering price of $12.345 per share": (None, None, None),
    "initial public offering price of $12.345 per share": (12.34, 12.34, None),
    "initial public offering price of $0.00 then per share $ 5.00": (5, 5, None),
    "range $20.00 to $10.00 per share": (None, None, None),
    "We are offering 3,846,153 of our ordinary shares": (None, None, 3846153),
    "We are offering 5,000 shares and 2,000,000 shares by others": (None, None, None),
    "per share $5. and more": (5, 5, None),
    "per\x1cshare $٧.٥٠": (7.5, 7.5, None),
    "99999999999999999999999 shares": (None, None, None),
}

TYPES = {
    "founder shares only": "unknown",
    "Founder Shares and a TRUST ACCOUNT": "spac",
    "currently listed on X; this is an initial public offering": "follow_on",
    "this is an initial  public offering": "unknown",
    "this is an initial\npublic offering": "unknown",
    "THIS IS AN INITIAL PUBLIC OFFERING": "ipo",
    "underwriting discount and commission; no active public market": "ipo",
    "underwriting discounts and commissions; no public market": "follow_on",
    "underwriting discounts and commissions; no active\npublic market": "follow_on",
    "underwriting discounts and commissions; no act\r public market": "ipo",
    "no active public market": "unknown",
    "nothing": "unknown",
    "": "unknown",
}


def extract(spark, covers):
    df = spark.createDataFrame(list(enumerate(covers)), "id int, cover string")
    return {row.cover: row for row in T.extract(df).collect()}


def test_price_and_shares(spark):
    got = extract(spark, COVERS)
    found = {c: (got[c].price_low, got[c].price_high, got[c].shares_offered) for c in COVERS}
    assert found == COVERS
    assert {row.extraction_method for row in got.values()} == {"regex"}


def test_types(spark):
    got = extract(spark, TYPES)
    assert {c: got[c].offering_type for c in TYPES} == TYPES


def test_share_count_without_digits_is_an_error_row(spark):
    cover = "This is an initial public offering. We are offering , shares. Per share $ 5.00"
    row = extract(spark, [cover])[cover]
    assert row.offering_type == "unknown" and row.extraction_method == "error"
    assert (row.shares_offered, row.price_low, row.price_high) == (None, None, None)


def test_digitless_match_after_an_accepted_one_does_not_matter(spark):
    cover = "We are offering 20,000 shares and then ,,,,, shares"
    assert extract(spark, [cover])[cover].shares_offered == 20000


def test_missing_cover_is_an_error_row(spark):
    row = extract(spark, [None])[None]
    assert row.offering_type == "unknown" and row.extraction_method == "error"


PIECES = st.sampled_from(
    ["we are offering", "We Are  Offering", "of our", "ordinary", "Class A", "shares", "Shares",
     "share", "ADS", "adss", "american depositary shares", "per share", "PER\nSHARE", "per unit",
     "to", "and", "-", "between", "price range of", "initial public offering price",
     "initial public offering price per share is", "price to the public", "price to public",
     "combined offering price of", "public offering price of", "$", "$5.00", "$ 12.5", "$1,250.00",
     "$700", "$0.00", "$16.", "$20.125", "10,000", "9,999", "1,000,000", "2,000,000,000", ",", ",,,,,",
     "12345", NBSP, "\t", "listed on the nyse", "trust account", "founder shares", "no", "active",
     "public market", "underwriting discounts and commissions", "this is an initial public offering"]
)


def by_hand(cover):
    """``(low, high, shares)`` or "error", reading the rules one by one."""
    text = re.sub(r"\s+", " ", cover)

    def groups(pattern):
        match = re.search(pattern, text, re.IGNORECASE)
        return match.groups() if match else ()

    price = (None, None)
    ranges = [tuple(map(float, groups(p))) for p in V.PRICE_RANGE_PATTERNS]
    singles = [tuple(map(float, groups(p))) * 2 for p in V.SINGLE_PRICE_PATTERNS]
    good = [r for r in ranges if r and 1 <= r[0] <= 500 and r[0] <= r[1]]
    good += [s for s in singles if s and 0.01 <= s[0] <= 500]
    price = good[0] if good else price
    for pattern in V.SHARE_PATTERNS:
        for digits in groups(pattern):
            if not digits.strip(","):
                return "error"
            if 10_000 <= int(digits.replace(",", "")) <= 1_000_000_000:
                return (*price, int(digits.replace(",", "")))
    return (*price, None)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map(" ".join), min_size=400, max_size=400, unique=True))
def test_random_covers(spark, covers):
    got = extract(spark, covers)
    for cover in covers:
        row, expected = got[cover], by_hand(cover)
        if expected == "error":
            assert row.extraction_method == "error"
        else:
            assert (row.price_low, row.price_high, row.shares_offered) == expected, cover

"""Hand-made edge fixtures E-1 (content) and E-2 (search) with known answers."""

import datetime as dt

from pyspark.sql import types as T

from viewpulse.sources.logs import CONTENT_OUT_SCHEMA, SEARCH_OUT_SCHEMA


def d(day, month=6):
    return dt.date(2022, month, day)


E1_ROWS = [
    ("A1", "CHANNEL", 100, d(1)), ("A1", "VOD", 100, d(1)), ("A1", "KPLUS", 500, d(2)),
    *[("B1", "RELAX", 10, d(i)) for i in range(1, 7)],
    *[("C1", "RELAX", 10, d(i)) for i in range(1, 6)],
    ("D1", "CHILD", None, d(3)),
    ("E1", "SPORT", -5, d(1)),
    ("F1", "FIMS", 0, d(1)),
    ("H1", "FIMS", 30, d(1)), ("H1", "VOD", 40, d(1)),
    ("u3", "CHANNEL", 5, d(1)),
    ("0", "CHANNEL", 999, d(1)),
    (None, "CHANNEL", 7, d(1)),
    ("G1", "channel", 9, d(1)),
]

# Contract -> (GT, PT, TT, TN, TH, MostWacth, Taste, Active)
E1_EXPECTED = {
    "A1": (None, 100, 500, None, 100, "Truyen Hinh", "Phim Truyen-Truyen Hinh", "Low"),
    "B1": (60, None, None, None, None, "Giai Tri", "Giai Tri", "High"),
    "C1": (50, None, None, None, None, "Giai Tri", "Giai Tri", "Low"),
    "D1": (None, None, None, None, None, None, "", "Low"),
    "E1": (None, None, -5, None, None, None, "The Thao", "Low"),
    "F1": (None, 0, None, None, None, "Phim Truyen", "Phim Truyen", "Low"),
    "H1": (None, 70, None, None, None, "Phim Truyen", "Phim Truyen", "Low"),
    "u3": (None, None, None, None, 5, "Truyen Hinh", "Truyen Hinh", "Low"),
}

E2_ROWS = [
    ("u1", "2022-06-01 08:00:00.000", "Tom"),
    ("u1", "2022-06-02 08:00:00.000", "tom!"),
    ("u1", "2022-06-03 08:00:00.000", "jerry"),
    ("u1", "2022-07-01 08:00:00.000", "VTV 3"),
    ("u1", "2022-07-02 08:00:00.000", "vtv-3"),
    ("u2", "2022-06-05 08:00:00.000", "tom"),
    ("u3", "2022-06-10 2:15:00 CH", "love story"),
    ("u3", "2022-07-05 11:00:00.123456", "potter"),
    ("u3", "2022-07-06 11:00:00", "love story"),
    ("u4", "2022-06-05 08:00:00.000", "ab"),
    ("u4", "2022-06-05 08:00:00.000", "K+"),
    ("u4", "2022-07-05 08:00:00.000", "bóng đá"),
    (None, "2022-06-05 08:00:00.000", "tom"),
    ("u5", "2022-06-05 08:00:00.000", None),
    ("u5", "2022-06-05 09:00:00.000", "bbb"),
    ("u5", "2022-06-06 09:00:00.000", "aaa"),
    ("u5", "2022-07-06 9:00:00.000 SA", "zzz"),
    ("u6", "2022-05-31 08:00:00.000", "tom"),
    ("u6", "2022-07-01 08:00:00.000", "tom"),
]

E2_MAP = [("tom", "Animation"), ("vtv 3", "TV Channel"), ("love story", "Romance"), ("aaa", "Other")]

E2_EXPECTED = {
    "u1": ("tom", 2, "vtv 3", 1, "Animation", "TV Channel", "Changed", "Animation-TV Channel"),
    "u3": ("love story", 1, "love story", 1, "Romance", "Romance", "Unchanged", "Unchanged"),
    "u5": ("aaa", 1, "zzz", 1, "Other", None, "Changed", "Other"),
}

END = dt.date(2022, 7, 14)
START = dt.date(2022, 6, 1)


def content_log(spark):
    return spark.createDataFrame(E1_ROWS, CONTENT_OUT_SCHEMA)


def search_log(spark):
    rows = []
    for i, (u, ts, kw) in enumerate(E2_ROWS):
        day = dt.date.fromisoformat(ts[:10])
        rows.append((u, kw, ts, f"isp{i % 2}", "box", "wifi", day))
    return spark.createDataFrame(rows, SEARCH_OUT_SCHEMA)


def keyword_map(spark):
    return spark.createDataFrame(E2_MAP, "keyword string, category string")


KMAP_SCHEMA = T.StructType([T.StructField("keyword", T.StringType()), T.StructField("category", T.StringType())])

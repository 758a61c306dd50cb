"""Cleaning of texts: literal cases, and an independent model of the identifiers."""

import base64
import uuid

import pytest
from pyspark.sql import functions as F

from sievecraft.functions import text as t

C = F.col("a")


def test_han_punctuation_stays(one):
    assert one(t.clean_main_text(C), a="竹雨松風，琴韻。\n茶煙梧月書聲！") == {"text": "竹雨松風，琴韻。\n茶煙梧月書聲！", "log": "unchanged"}


def test_long_verses_and_private_characters(one):
    long = "詩篇" + "甲乙丙" * 100 + "：8"
    assert one(t.clean_main_text(C), a=f"{long}\n甲-乙\n12–13 1.5 \ue002春\ue000")["text"] == f"{long}\n甲-乙\n12-13 1.5 \ue002春\ue000"
    assert one(t.restore_verses(t.protect_verses(C)), a="3:4 x:y 5-6") == "3：4 x:y 5-6"


def test_icons_latin_and_western_marks_go(one):
    got = one(t.clean_main_text(C), a="竹雨松風琴韻❤★\nHello茶煙梧月？OK!")
    assert "茶煙梧月？" in got["text"] and not set("❤★!HelloOK") & set(got["text"])


def test_device_mark(one):
    got = one(t.clean_main_text(C), a="臨江仙\nREDMI NOTE 12 2024/01/02 12:30:00")
    assert got["text"] == "臨江仙" and "device_wm_or_timestamp" in got["log"]


def test_verse_and_year_digits(one):
    got = one(t.clean_main_text(C), a="詩篇五十九：8\n作於2024年")["text"]
    assert "：8" in got and "2024" in got


def test_hard_strip_and_repeats(one):
    assert one(t.clean_main_text(C, False), a="竹雨，松風。") == {"text": "竹雨松風", "log": "punct_strip_all_modern"}
    assert one(t.clean_main_text(C), a="龍" * 8) == {"text": "龍", "log": "hallucination_repeat_ge6"}
    assert one(t.clean_main_text(C), a="莫莫莫")["text"] == "莫莫莫"
    assert one(t.clean_main_text(C), a=" 　 ") == {"text": "", "log": "empty"}


def test_side_text_and_pair(one):
    assert one(t.clean_side_text(C), a="[seal]\n壬寅秋\n👍") == "壬寅秋"
    off = one(t.clean_pair(C, F.col("b"), enabled=False), a="竹★", b="[seal]款")
    assert (off["main"], off["side"], off["changed"], off["log"]) == ("竹★", "[seal]款", False, "disabled")
    on = one(t.clean_pair(C, F.col("b")), a="竹★雨", b="款♥\n[seal]")
    assert (on["main"], on["side"], on["changed"]) == ("竹雨", "款", True)


def test_verses_protected_once(one):
    assert one(t.restore_verses(F.regexp_replace(t.protect_verses(C), t.MODERN_MARKS, "")), a="九：8.3 3:16 a:b") == "九：83 3：16 ab"


@pytest.mark.parametrize("raw, want", [("123", "123"), ("UzpfSTYxNTY3MDMzNTY4NTAwOlZLOjI3NDMzMDgxMjg5NzAzMjI5", "27433081289703229"), (base64.b64encode(b"x12345678").decode().rstrip("="), "12345678"), ("??", None), ("", None)])
def test_post_ids(one, raw, want):
    assert one(t.decode_post_id(C), a=raw) == want


def test_dates(one):
    for raw, want in (("2024-01-05", "2024-01-05"), ("on Sept 7, 2023", "2023-09-07"), ("7 March 2020", "2020-03-07"), ("2024/13/40", None), ("no", None)):
        got = one(t.parse_date(C), a=raw)
        assert (got and got.date().isoformat()) == want


def test_uuid5(one):
    assert one(t.name_uuid(F.lit(str(uuid.NAMESPACE_OID)), C), a="doc|3|4") == str(uuid.uuid5(uuid.NAMESPACE_OID, "doc|3|4"))


def test_links(one):
    link = t.choose_link("https://s.example", F.lit("g"), F.lit("7"), C)
    assert one(link, a="https://s.example/p/7") == "https://s.example/p/7"
    assert one(link, a="https://other.example/p/7") == "https://s.example/groups/g/permalink/7/"
    assert one(t.post_id_of_url(C), a="https://x/groups/1/posts/22/?story_fbid=3") == "22"
    assert one(t.image_extension(C), a="https://x/a.JPEG?s=1") == ".jpg"
    assert one(t.safe_id(C), a="") == "unknown"


def test_json_in_replies(one):
    assert one(t.json_object_text(C), a='<think>{"a":1}</think>\n```json\n{"a": [1, 2,],}\n```') == '{"a": [1, 2]}'
    assert one(t.json_object_text(C), a="none") is None
    assert one(t.optional_int(C), a="page 12 of 3") == 12 and one(t.optional_int(C), a="70000000001") == 70_000_000_001 and one(t.optional_int(C), a="9" * 30) is None


def test_prepend_and_captions(one):
    assert one(t.prepend_once(C, F.lit("上 卷")), a="上卷一") == "上卷一"
    assert one(t.prepend_once(C, F.lit("上卷")), a="一") == "上卷\n一"
    assert one(t.strip_caption_noise(C), a="見 https://x.y #標籤 @me 春風abc") == "見 春風"
    use = t.caption_use(C, F.array(*map(F.lit, "春風又綠")))
    assert one(use, a="春風又綠江南岸")["align"] == "quote" and one(use, a="abc")["align"] == "empty" and one(use, a="山水花鳥")["align"] == "unrelated"


@pytest.mark.parametrize("url, group, want", [
    ("https://x.org/groups/12/permalink/34/?comment_id=5#c", "", "https://s.org/groups/12/permalink/34/"),
    ("https://x.org/groups/12/permalink/34/", "99", ""),
    ("https://x.org/groups/12/posts/pfbid0Ab/?x", "12", "https://s.org/groups/12/posts/pfbid0Ab/"),
    ("https://x.org/story.php?story_fbid=7&id=8", "", "https://s.org/groups/8/permalink/7/"),
    ("https://x.org/story.php?story_fbid=7&id=8", "5", "https://s.org/groups/5/permalink/7/"),
    ("https://x.org/photo.php?story_fbid=7&id=8", "", ""),
    ("https://x.org/login/?next=/groups/12/permalink/34/", "", ""),
    ("https://x.org/story.php?story_fbid=7", "", ""),
    ("  ", "", ""), (None, "", ""),
])
def test_canonical_permalink(one, url, group, want):
    assert one(t.canonical_permalink("https://s.org", F.lit(url).cast("string"), F.lit(group))) == want

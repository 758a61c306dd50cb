"""Cleaning and reading of captions, labels and recognised text, as column expressions.

Every function takes and returns columns and stays inside the JVM. A null text counts
as empty. The script that counts as content, its variants and the noise lists are
parameters; the defaults are the fixed values below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import blank, chars, let, lines, non_empty, strip

# They decide results and are stated as they must be.
HAN = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
HAN_PUNCTUATION = "，。、；：？！「」『』（）《》〈〉【】—–…·‥〃"
DEVICES = ("REDMI", "IPHONE", "SAMSUNG", "HUAWEI", "VIVO", "OPPO", "XIAOMI")
DEVICE_LINE = rf"(?i)(?:{'|'.join(DEVICES)})[^\n]*"
TIMESTAMP = r"\d{4}[./-]\d{2}[./-]\d{2}(?:\s+\d{2}:\d{2}(?::\d{2})?)?"
SIZE_MARK = r"(?:尺寸\s*[:：]\s*)?\d+(?:\.\d+)?\s*(?:[xX×*]\s*\d+(?:\.\d+)?)+(?:\s*(?:cm|mm))?"
LENGTH_MARK = r"\d+(?:\.\d+)?\s*(?:cm|mm)"
GRID_MARK = r"\d+\s*格"
TAGS = r"(?i)\[seal\]|\[unreadable\]|\[other\]|inktext|margin"
VERSE = r"[\x{4E00}-\x{9FFF}]+[:：]\d+|\d+[-–—~]\d+|\d+[:：.]\d+"
WESTERN_MARKS = r"""[?!~～;,."'`()\[\]{}*^#@%&_+=|\\/<>]"""
MODERN_MARKS = r"[?？!！~～:：;；,，。、“”‘’（）()《》〈〉【】\[\].*^#@%&_+=|\\/`]"
ICONS = "♥👍☉■□💜🔷◆^★☆▲▼●○◇"
REPEAT = r"([^\s])(?:\s*\1){5,}"
SIMPLIFIED = "东丝两严丧个临为丽举么义乌乐乔习乡书买乱争于亏云亚产亩亲亿仅从仑仓仪们价众优会伞伟传伤伦伪体余侠侣侦侧侨俭债儿党兰关兴养兽冈军农冯陈静学给墙数门马风飞龙场经与无对开时实现点当还这过国车长电语说读请谢见觉观欢气汉万击冲决况净准凉减医听响后术权条湾来虽则论远将难连"
TRADITIONAL = "東絲兩嚴喪個臨為麗舉麼義烏樂喬習鄉書買亂爭於虧雲亞產畝親億僅從侖倉儀們價眾優會傘偉傳傷倫偽體餘俠侶偵側僑儉債兒黨蘭關興養獸岡軍農馮陳靜學給牆數門馬風飛龍場經與無對開時實現點當還這過國車長電語說讀請謝見覺觀歡氣漢萬擊衝決況淨準涼減醫聽響後術權條灣來雖則論遠將難連"
VARIANTS, VARIANT_OF = "脩爲裏着恒啓羣眞麪峯綫牀敎舘説", "修為裡著恆啟群真麵峰線床教館說"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


#: Noncharacters, which no text for interchange holds, in place of a connector.
_COLON, _DASH, _DOT = map(chr, (0xFDD0, 0xFDD1, 0xFDD2))


def strip_noise(text: Column) -> Column:
    """Struct (text, rules): device marks, times, sizes and tags removed, and which kinds were met."""
    t = F.coalesce(text, F.lit(""))
    steps = [("device_wm_or_timestamp", (DEVICE_LINE, "(?U)" + TIMESTAMP)), ("seal_size_or_grid", tuple("(?U)" + p for p in (SIZE_MARK, LENGTH_MARK, GRID_MARK))), ("seal_or_tech_tag", (TAGS,))]

    def run(value: Column, rules: Column, rest: list) -> Column:
        if not rest:
            return F.struct(value.alias("text"), rules.alias("rules"))
        name, patterns = rest[0]
        after = value
        for p in patterns:
            after = F.regexp_replace(after, p, "")
        return let(after, lambda a: run(a, F.when(a != value, F.concat(rules, F.array(F.lit(name)))).otherwise(rules), rest[1:]))

    return run(t, F.array().cast("array<string>"), steps)


def protect_verses(text: Column) -> Column:
    """Connectors inside verse references, however long, as characters that no text holds."""
    verse = f"(?U)(?:{VERSE})"
    marked = lambda v: F.translate(v, ":：-–—.", _COLON * 2 + _DASH * 3 + _DOT)
    both = F.struct(F.split(text, verse).alias("between"), F.regexp_extract_all(text, F.lit(verse), F.lit(0)).alias("verses"))
    return let(both, lambda x: F.array_join(F.transform(x["between"], lambda p, i: F.concat(p, F.coalesce(marked(F.get(x["verses"], i)), F.lit("")))), ""))


def restore_verses(text: Column) -> Column:
    return F.translate(text, _COLON + _DASH + _DOT, "：-.")


def strip_icons(text: Column) -> Column:
    """Emoji and symbol characters removed; content script and its punctuation stay."""
    emoji = rf"[{ICONS.replace('^', chr(92) + '^')}\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]"
    symbols = rf"[\p{{So}}\p{{Sk}}&&[^\x{{3000}}-\x{{303F}}{HAN}\x{{20000}}-\x{{2FA1F}}{HAN_PUNCTUATION}]]"
    return F.regexp_replace(text, f"{emoji}|{symbols}", "")


def collapse_repeats(text: Column) -> Column:
    """A character six times or more in a row, blanks between allowed, becomes one."""
    return F.regexp_replace(text, "(?U)" + REPEAT, "$1")


def clean_main_text(text: Column, keep_han_punctuation: bool = True, letters: str = "[a-zA-Z]+") -> Column:
    """Struct (text, log) of a page's main text; log names the rules that changed it, or unchanged or empty.

    ``letters``: what counts as foreign writing and goes; pass an impossible pattern to keep all.
    """
    marks = WESTERN_MARKS if keep_han_punctuation else MODERN_MARKS
    marks_rule = "punct_strip_keep_han" if keep_han_punctuation else "punct_strip_all_modern"

    def add(rules: Column, name: str, when: Column) -> Column:
        return F.when(when, F.concat(rules, F.array(F.lit(name)))).otherwise(rules)

    def after_noise(n: Column) -> Column:
        bare = restore_verses(F.regexp_replace(protect_verses(n["text"]), marks, ""))
        return let(bare, lambda b: after_marks(b, add(n["rules"], marks_rule, b != n["text"])))

    def after_marks(b: Column, rules: Column) -> Column:
        return let(F.regexp_replace(strip_icons(b), letters, ""), lambda i: after_icons(i, add(rules, "icons_emoji_or_latin", i != b)))

    def after_icons(i: Column, rules: Column) -> Column:
        return let(collapse_repeats(i), lambda c: F.struct(F.array_join(lines(c), "\n").alias("text"), F.array_join(add(rules, "hallucination_repeat_ge6", i.rlike("(?U)" + REPEAT)), "; ").alias("log")))

    def named(x: Column) -> Column:
        return F.struct(x["text"].alias("text"), F.when(x["log"] == "", "unchanged").otherwise(x["log"]).alias("log"))

    return F.when(blank(text), F.struct(F.lit("").alias("text"), F.lit("empty").alias("log"))).otherwise(let(let(strip_noise(strip(text)), after_noise), named))


def clean_side_text(text: Column) -> Column:
    """Notes beside the main text: noise and icons removed, lines trimmed."""
    return F.array_join(lines(strip_icons(strip_noise(strip(text))["text"])), "\n")


def clean_pair(main: Column, side: Column, enabled: bool = True, keep_han_punctuation: bool = True) -> Column:
    """Struct of both texts, cleaned and raw, the log, and whether anything changed."""
    raw_main, raw_side = F.coalesce(main, F.lit("")), F.coalesce(side, F.lit(""))
    if not enabled:
        return F.struct(raw_main.alias("main"), raw_side.alias("side"), raw_main.alias("main_raw"), raw_side.alias("side_raw"), F.lit("disabled").alias("log"), F.lit(False).alias("changed"))
    both = F.struct(clean_main_text(main, keep_han_punctuation).alias("m"), clean_side_text(side).alias("s"))
    return let(both, lambda x: F.struct(x["m"]["text"].alias("main"), x["s"].alias("side"), raw_main.alias("main_raw"), raw_side.alias("side_raw"), x["m"]["log"].alias("log"), ((x["m"]["text"] != raw_main) | (x["s"] != raw_side)).alias("changed")))


def compact(text: Column, keep: str = HAN) -> Column:
    """Only the characters of the content script; ``keep`` is the inside of a character class."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{keep}]", "")


def has_content(text: Column, keep: str = HAN) -> Column:
    """Whether ``compact`` leaves anything; the first such character decides."""
    return F.coalesce(text.rlike(f"[{keep}]"), F.lit(False))


def to_traditional(text: Column) -> Column:
    return _translated(text, SIMPLIFIED, TRADITIONAL)


def _translated(text: Column, source: str, target: str) -> Column:
    """F.translate, which looks up every character, only for texts that hold a character between the least and the greatest of the source."""
    t = F.coalesce(text, F.lit(""))
    return let(t, lambda x: F.when(x.rlike(f"[{min(source)}-{max(source)}]"), F.translate(x, source, target)).otherwise(x))


def fold_variants(text: Column) -> Column:
    return _translated(text, VARIANTS, VARIANT_OF)


def norm(text: Column, keep: str = HAN) -> Column:
    """The form in which texts are compared: content script, traditional, variants folded."""
    return fold_variants(compact(to_traditional(text), keep))


def strip_caption_noise(text: Column, keep: str = HAN) -> Column:
    """Links, hashtags, mentions and other scripts become blanks; blanks are squeezed."""
    t = F.coalesce(text, F.lit(""))
    for pattern in (r"(?i)https?://\S+", r"(?U)[#＃][\w\x{3400}-\x{9FFF}]+", r"(?U)@[\w.]+", rf"(?U)[^{keep}\s]"):
        t = F.regexp_replace(t, pattern, " ")
    return strip(F.regexp_replace(t, r"(?U)\s+", " "))


def caption_use(caption: Column, allowed: Column, keep: str = HAN) -> Column:
    """Struct (align, hint): quote if the caption shares 4 characters or half of its own with the array allowed."""
    hint = compact(to_traditional(strip_caption_noise(caption, keep)), keep)

    def judged(c: Column) -> Column:
        shared = F.size(F.filter(chars(c), lambda x: F.array_contains(allowed, x)))
        quote = (F.size(allowed) > 0) & ((shared >= 4) | (shared / F.greatest(F.length(c), F.lit(1)) >= 0.5))
        return F.when(c == "", F.struct(F.lit("empty").alias("align"), F.lit("").alias("hint"))).when(quote, F.struct(F.lit("quote").alias("align"), c.alias("hint"))).otherwise(F.struct(F.lit("unrelated").alias("align"), F.lit("").alias("hint")))

    return let(hint, judged)


def normalise_label(text: Column) -> Column:
    # Runs that are one space already are not replaced.
    return F.regexp_replace(F.lower(strip(text)), r"(?U) \s+|[^\S ]\s*", " ")


def parse_date(text: Column) -> Column:
    """Timestamp of the first absolute date in one of three layouts; null if none is a real date."""
    month = lambda m: F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(m), 1, 3)).cast("string")
    real = lambda y, m, d: F.when((y != "") & (m != "0"), F.expr("true")) & y.isNotNull()
    tries = []
    for pattern, y, m, d, named in ((r"(20\d{2})[-/](\d{1,2})[-/](\d{1,2})", 1, 2, 3, False), (r"([A-Za-z]{3,9})\s+(\d{1,2}),?\s+(20\d{2})", 3, 1, 2, True), (r"(\d{1,2})\s+([A-Za-z]{3,9})\s+(20\d{2})", 3, 2, 1, True)):
        part = lambda i, p=pattern: F.regexp_extract(text, p, i)
        mm = month(part(m)) if named else part(m)
        tries.append(F.when(real(part(y), mm, part(d)), F.try_to_timestamp(F.concat_ws("-", part(y), F.lpad(mm, 2, "0"), F.lpad(part(d), 2, "0")), F.lit("yyyy-MM-dd"))))
    return F.coalesce(*tries)


def parse_unix_seconds(value: Column) -> Column:
    """Timestamp of seconds since 1970, if later than 10**9."""
    n = F.expr("null").cast("bigint") if value is None else value.cast("string").try_cast("bigint")
    return F.when(n > 1_000_000_000, F.timestamp_seconds(n))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def decode_post_id(text: Column) -> Column:
    """Digits as they are; base64 that holds ``VK:digits`` or eight digits or more; else null."""
    t = strip(text)
    padded = F.concat(t, F.repeat(F.lit("="), ((4 - F.length(t) % 4) % 4).cast("int")))
    plain = F.decode(F.try_to_binary(padded, F.lit("base64")), "UTF-8")
    named = F.regexp_extract(plain, r"VK:(\d+)", 1)
    digits = F.regexp_replace(plain, r"\D", "")
    return F.when(t.rlike(r"^\d+$"), t).when(named != "", named).when(F.length(digits) >= 8, digits)


def url_base(url: Column) -> Column:
    return strip(F.substring_index(F.coalesce(url, F.lit("")), "?", 1))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


#: Where a post's number stands in its address; the first that matches counts.
POST_ID_PATTERNS = (r"/permalink/(\d+)", r"/posts/(\d+)", r"story_fbid=(\d+)", r"multi_permalinks=(\d+)", r"fbid=(\d+)", r"/photos/[^/]+/(\d+)")


def post_id_of_url(url: Column, patterns: tuple[str, ...] = POST_ID_PATTERNS) -> Column:
    found = [F.regexp_extract(F.coalesce(url, F.lit("")), p, 1) for p in patterns]
    return F.coalesce(*[F.when(f != "", f) for f in found], F.lit(""))


def permalink(site: str, group: Column, post: Column) -> Column:
    return F.concat(F.lit(f"{site}/groups/"), group, F.lit("/permalink/"), post, F.lit("/"))


def canonical_permalink(site: str, url: Column, group: Column) -> Column:
    """The clean address of a group's post, or empty.

    Queries and fragments go. Addresses of log-in, check, recovery or media pages, of
    another group than a given one, and of anything but a post are empty. A story number
    in the query counts if the page is no photo; its group is the given one, else the
    query's ``id``.
    """
    raw, own = strip(url), strip(group)
    no_hash = F.substring_index(raw, "#", 1)
    path = F.substring_index(no_hash, "?", 1)
    bad = F.lower(raw).rlike("/login|/checkpoint|/recover|/media/")
    first = lambda text, pattern, i: F.regexp_extract(text, pattern, i)
    link, post = r"/groups/([0-9]+)/permalink/([0-9]+)", r"/groups/([0-9]+)/posts/(pfbid[0-9A-Za-z]+|[0-9]+)"
    made = lambda pattern, kind: F.when((own != "") & (first(path, pattern, 1) != own), "").otherwise(F.concat(F.lit(f"{site}/groups/"), first(path, pattern, 1), F.lit(f"/{kind}/"), first(path, pattern, 2), F.lit("/")))
    story, owner = first(no_hash, r"(?i)[?&]story_fbid=([0-9]+)", 1), F.when(own != "", own).otherwise(first(no_hash, r"[?&]id=([0-9]+)", 1))
    told = (story != "") & (owner != "") & ~F.lower(path).contains("/photo")
    return F.when((raw == "") | bad, "").when(path.rlike(link), made(link, "permalink")).when(path.rlike(post), made(post, "posts")).when(told, permalink(site, owner, story)).otherwise("")


def choose_link(site: str, group: Column, post: Column, existing: Column) -> Column:
    """The known link if it is on the site and about the post, else the one built from the ids, else the known one."""
    have, g, p = strip(existing), strip(group), strip(post)
    host = site.split("://", 1)[-1].removeprefix("www.")
    good = have.startswith("http") & F.lower(have).contains(host) & ((p == "") | F.contains(have, p))
    return F.when(good, have).when((g != "") & (p != "") & (p != "unknown"), permalink(site, g, p)).otherwise(have)


def safe_id(text: Column) -> Column:
    """A file-name-safe id of 64 characters at most."""
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9A-Za-z_-]", "_"), 1, 64), F.lit("")), F.lit("unknown"))


def image_extension(url: Column, content_type: Column | None = None) -> Column:
    """By content type, else by the address, else .jpg."""
    known = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif"}
    ext = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"\.(jpe?g|png|webp|gif)(?:$|\?)", 1)
    by_url = F.when(ext.startswith("jp"), ".jpg").when(ext != "", F.concat(F.lit("."), ext)).otherwise(".jpg")
    if content_type is None:
        return by_url
    out = F
    for k, v in known.items():
        out = out.when(content_type == k, v)
    return out.otherwise(by_url)


def content_id(author: Column, caption: Column, first_image: Column) -> Column:
    """md5 of what is known of a post that has no id."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return F.md5(F.concat_ws("|", F.substring(e(author), 1, 40), F.substring(e(caption), 1, 180), F.substring_index(e(first_image), "?", 1)).cast("binary"))


def name_uuid(namespace: Column, name: Column) -> Column:
    """The name-based UUID, version 5, of a name in a namespace UUID."""
    h = F.sha1(F.concat(F.unhex(F.regexp_replace(namespace, "-", "")), name.cast("binary")))
    variant = F.lower(F.conv(F.expr("0") + (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 8), 10, 16))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def json_object_text(text: Column) -> Column:
    """The JSON object inside a model's reply: thoughts, fences and trailing commas removed; null if there is none."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?is)<think>.*?</think>", "")
    t = F.regexp_replace(t, r"(?m)^\s*```[A-Za-z]*\s*$", "")
    body = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    body = F.regexp_replace(body, r'\\(?!["\\/bfnrtu])', r"\\\\")
    return F.nullif(F.regexp_replace(body, r",\s*([}\]])", "$1"), F.lit(""))


BODY = "page_header string, printed_page string, ngay_thang string, the_loai string, de_tai string, blocks array<struct<script:string,text:string>>"
ENTRY = "stt string, ngay_thang string, to_tap string, the_loai string, xuat_xu string, de_tai string, trich_yeu string"
SCRIPTS = ("han_nom", "quoc_ngu", "mixed")


def parse_body(text: Column) -> Column:
    """Struct (page_header, printed_page, ngay_thang, the_loai, de_tai, blocks, parse_ok) of a model's reply about a page.

    Blocks without text go, an unknown script is mixed, and without any block the whole
    reply is one. A reply without a JSON object is one block, and not ok.
    """
    names = ("page_header", "ngay_thang", "the_loai", "de_tai")
    one = lambda t: F.array(F.struct(F.lit("mixed").alias("script"), t.alias("text")))

    def block(b: Column) -> Column:
        script = F.lower(strip(b["script"]))
        return F.struct(F.when(script.isin(*SCRIPTS), script).otherwise("mixed").alias("script"), strip(b["text"]).alias("text"))

    def made(x: Column) -> Column:
        j, raw = x["j"], x["raw"]
        kept = F.filter(F.transform(F.coalesce(j["blocks"], F.array().cast("array<struct<script:string,text:string>>")), block), lambda b: b["text"] != "")
        blocks = F.when(j.isNull(), one(raw)).when((F.size(kept) == 0) & (raw != ""), one(raw)).otherwise(kept)
        return F.struct(*[j[n].alias(n) for n in names], optional_int(j["printed_page"]).alias("printed_page"), blocks.alias("blocks"), j.isNotNull().alias("parse_ok"))

    found = json_object_text(text)
    parsed = F.when(F.call_function("try_parse_json", found).isNotNull(), F.from_json(found, BODY))
    return let(F.struct(parsed.alias("j"), strip(text).alias("raw")), made)


def parse_entries(text: Column) -> Column:
    """The entries of a contents page in a model's reply, in order of their positive numbers; entries without one go."""
    found = json_object_text(text)
    parsed = F.from_json(found, f"entries array<struct<{', '.join(c.strip().replace(' ', ':') for c in ENTRY.split(','))}>>")["entries"]
    numbered = F.transform(parsed, lambda e: F.struct(optional_int(e["stt"]).alias("number"), *[non_empty(e[c.split()[0]]).alias(c.split()[0]) for c in ENTRY.split(", ")[1:]]))
    return F.coalesce(F.array_sort(F.filter(numbered, lambda e: e["number"] > 0)), F.array().cast(f"array<struct<number:int,{','.join(c.replace(' ', ':') for c in ENTRY.split(', ')[1:])}>>"))


def belongs_to_group(node: Column, group: Column, head: int = 4000) -> Column:
    """Whether a node's JSON names the group as an owner or target, or names none, within its first characters.

    The limit is the test's own rule: owners stand at a node's head.
    """
    owner = r'"(?:owning_profile|to|group|target_group)"\s*:\s*\{[^{}]*"id"\s*:\s*"([0-9]+)"'
    named = F.regexp_extract_all(F.substring(F.coalesce(node, F.lit("")), 1, head), F.lit(owner), F.lit(1))
    return (F.size(named) == 0) | F.array_contains(named, group)


def optional_int(text: Column) -> Column:
    """The number, else the first run of digits in it, else null; numbers beyond 64 bits are null."""
    t = strip(text.cast("string"))
    return F.coalesce(t.try_cast("long"), F.regexp_extract(t, r"(\d+)", 1).try_cast("long"))


def prepend_once(text: Column, leak: Column) -> Column:
    """leak before text, unless text holds it already when blanks are left out."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    return F.when((bare(leak) == "") | F.contains(bare(text), bare(leak)), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.filter(F.array(strip(leak), strip(text)), lambda x: x != ""), "\n"))


def script_ratios(text: Column, keep: str = HAN) -> Column:
    """Struct (content, latin): shares among the characters that are not blanks."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")
    share = lambda b, p: F.when(F.length(b) == 0, 0.0).otherwise(F.regexp_count(b, F.lit(p)) / F.length(b))
    return let(bare, lambda b: F.struct(share(b, f"[{keep}]").alias("content"), share(b, "[A-Za-z]").alias("latin")))


def latin_heavy(text: Column, keep: str = HAN) -> Column:
    """Eight Latin letters, or six that are two fifths of the content characters."""
    n = lambda p: F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p))
    return (n("[A-Za-z]") >= 8) | ((n("[A-Za-z]") >= 6) & (n("[A-Za-z]") >= 0.4 * F.greatest(n(f"[{keep}]"), F.lit(1))))


def canonical(value: Column, aliases: dict[str, str], fallback: Column | None = None) -> Column:
    """A tag by its alias, in lower case; unknown ones become the fallback, or stay when there is none."""
    v = F.lower(strip(value))
    out = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), v), fallback if fallback is not None else F.nullif(v, F.lit("")))
    return out

"""Validity, deduplication, joins and merges of post records.

All operators are joins and aggregations that combine on the map side; "first" and
"last" are decided by an explicit order column, never by arrival. A null key never
matches anything.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import blank, let, non_empty, strip
from ..functions.text import normalise_label, url_base

# Captions that are only a page's controls, and patterns of such captions.
NOISE = (
    "like", "comment", "share", "see more", "see less", "all reactions",
    "thích", "bình luận", "chia sẻ", "xem thêm", "xem bớt", "tất cả cảm xúc",
    "xem bản dịch", "see translation", "viết bản dịch", "write a translation",
    "người đóng góp nổi bật", "top contributor", "most relevant", "liên quan nhất",
    "follow", "theo dõi", "message", "nhắn tin", "join", "tham gia",
    "invite", "mời", "featured", "đáng chú ý", "photos", "ảnh",
    "xem bài viết", "view post", "see post",
    "hãy là người đầu tiên bình luận", "be the first to comment",
    "write a comment", "viết bình luận", "write comment",
    "bình luận đầu tiên", "first comment", "no comments yet",
    "chưa có bình luận", "react", "phản ứng",
    "nhóm công khai", "public group", "nhóm riêng tư", "private group",
    "nhóm kín", "closed group", "nhóm bí mật", "secret group",
)
NOISE_PATTERNS = (
    r"^\d+[\s,.]*(lượt thích|likes?|reactions?)\b",
    r"^\d+[\s,.]*(bình luận|comments?|shares?|chia sẻ)\b",
    r"^(hãy là|be the)\s+(người|first)\s",
    r"\b(lượt thích|người thích|people reacted|reacted to this)\b",
    r"\b(đã bình luận|commented on this|view insights)\b",
    r"^(photo|ảnh|video)\s*(\d+\s*of|/)",
    r"^\d+\s*(giờ|phút|ngày|tuần|tháng|năm|hours?|minutes?|days?|weeks?|months?|years?)\b",
    r"bất kỳ ai cũng có thể",
    r"nhìn thấy mọi người trong nhóm",
    r"những gì họ đăng",
    r"anyone can see (everyone|who.s|all members)",
    r"what.?s posted in (the )?group",
    r"visible to (all )?group members",
    r"chỉ thành viên (nhóm )?mới (xem|thấy)",
    r"^nhóm\s+(công khai|riêng tư|kín|bí mật)\b",
    r"^(public|private|closed|secret)\s+group\b",
    r"(lượt thích|people talking|đang nói về|người đang nói|\blikes?\b|followers?|người theo dõi|lượt theo dõi|người đầu tiên bình luận|first to comment|這是書法社團|其他都不准貼文|用政治相關寫書法)",
)
#: Each match of a pattern that is not bound to the start holds one of these.
NOISE_WORDS = (
    "lượt thích", "người thích", "people reacted", "reacted to this", "đã bình luận", "commented on this", "view insights", "bất kỳ ai cũng", "nhìn thấy mọi người", "những gì họ đăng", "anyone can see", "s posted in ", "visible to ", "chỉ thành viên",
    "people talking", "đang nói về", "người đang nói", "like", "follower", "người theo dõi", "lượt theo dõi", "người đầu tiên", "first to comment", "這是書法社團", "其他都不准貼文", "用政治相關寫書法",
)
CONTENT = r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{3040}-\x{30FF}\x{AC00}-\x{D7AF}]"
DIACRITICS = "[àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữỳýỵỷỹđ]"
STATUS_RANK = ("pending", "invalid", "valid")
RECHECKABLE = ("missing_label", "missing_image", "missing_label_and_image")
EXHAUSTED = "recheck_exhausted"


def is_noise(label: Column, noise: Sequence[str] = NOISE, patterns: Sequence[str] = NOISE_PATTERNS) -> Column:
    """Blank, or only controls: a noise text, one at its start, one anywhere in 64 characters, or a pattern."""
    any_of = "|".join(re.escape(x) for x in noise)
    joined = lambda ps: "(?iU)" + "|".join(f"(?:{p})" for p in ps)

    def found(n: Column) -> Column:
        if tuple(patterns) != NOISE_PATTERNS:
            return n.rlike(joined(patterns))
        # Bound patterns look at the start only; for the others texts are searched that hold a word of theirs (two letters fold to plain ones).
        first = "(?iU)^(?:" + "|".join(p[1:] for p in patterns if p.startswith("^")) + ")"
        def holds(t: Column) -> Column:
            # Words of plain letters in all texts; the others in texts that have other letters.
            plain, others = (F.array_contains(F.array(*[F.contains(t, F.lit(w)) for w in NOISE_WORDS if w.isascii() == a]), True) for a in (True, False))
            return plain | ((F.octet_length(t) > F.length(t)) & others)

        folded = F.when(F.octet_length(n) > F.length(n), F.replace(F.replace(n, F.lit("ſ"), F.lit("s")), F.lit("ı"), F.lit("i"))).otherwise(n)
        return n.rlike(first) | (let(folded, holds) & n.rlike(joined(p for p in patterns if not p.startswith("^"))))

    return let(normalise_label(label), lambda n: (n == "") | n.rlike(f"^(?:{any_of})(?: |$)") | ((F.length(n) <= 64) & n.rlike(f"(?:{any_of})")) | found(n))


def _written(t: Column) -> Column:
    """Content script; or long with diacritics; or with words; or long plain ASCII."""
    # The second word ends the search, so most texts are settled by their beginning; the rest of the rules read all of a text.
    words = F.size(F.split(t, "[A-Za-z]{4,}", 3)) == 3
    return ((F.length(t) >= 16) & words) | t.rlike(CONTENT) | ((F.length(t) >= 20) & t.rlike("(?iu)" + DIACRITICS)) | ((F.length(t) >= 20) & t.rlike(r"""(?U)^[A-Za-z0-9\s.,!?'"\-:#@]+$"""))


def is_content(label: Column) -> Column:
    """Real text and no noise."""
    return let(strip(label), lambda t: (t != "") & _written(t)) & ~is_noise(label)


def classify(label: Column, images: Column) -> Column:
    """Struct (valid, reason). Noise and lack of content outrank a missing image."""
    none = F.coalesce(F.size(images), F.lit(0)) <= 0

    def judged(t: Column) -> Column:
        return F.when((t == "") & none, "missing_label_and_image").when(t == "", "missing_label").when(is_noise(t), "ui_noise_caption").when(~_written(t), "not_content_caption").when(none, "missing_image")

    return let(let(strip(label), judged), lambda reason: F.struct(reason.isNull().alias("valid"), reason.alias("reason")))


def discover_reason(reason: Column) -> Column:
    """The names that discover rows use."""
    return F.when(reason == "missing_label", "missing_caption").when(reason == "missing_label_and_image", "missing_caption_and_image").otherwise(reason)


def incomplete_reason(caption: Column, images: Column) -> Column:
    none = F.coalesce(F.size(images), F.lit(0)) <= 0
    return F.when(blank(caption) & none, "missing_caption_and_image").when(blank(caption), "missing_caption").when(none, "missing_image")


def deliverable(rows: DataFrame, allow_empty_label: bool = False) -> DataFrame:
    """Export rows: valid only with a label (unless empty ones are allowed) and images; the reason follows."""
    label_ok = F.lit(True) if allow_empty_label else ~blank(F.col("caption"))
    has_images = F.coalesce(F.size("image_urls"), F.lit(0)) > 0
    ok = F.coalesce(F.col("valid"), F.lit(False)) & label_ok & has_images
    reason = F.when(~ok, F.coalesce(non_empty(F.col("invalid_reason")), incomplete_reason(F.col("caption"), F.col("image_urls")), F.lit("invalid")))
    return rows.select("post_id", F.coalesce("caption", F.lit("")).alias("label"), F.col("image_urls").alias("images"), ok.alias("is_valid"), reason.alias("invalid_reason"))


def pass_through(rows: DataFrame, batch_seq: int, run_id: str, schema_version: str = "") -> DataFrame:
    """Rows that are complete already, as the next step's records: valid, with their distinct images and no reason.

    rows: post_id, permalink, caption, image_urls, valid, and, if there, cdn_urls, author, author_hint, posted_at.
    Only valid rows with a caption and an image that is no video pass.
    """
    text = lambda *names: F.coalesce(*[non_empty(F.col(c).cast("string")) for c in names if c in rows.columns], F.lit(""))
    urls = F.coalesce(*[F.when(F.size(c) > 0, F.col(c)) for c in ("image_urls", "cdn_urls") if c in rows.columns], F.array().cast("array<string>"))
    posted = F.col("posted_at") if "posted_at" in rows.columns else F.lit(None).cast("string")
    ready = rows.where(F.coalesce(F.col("valid"), F.lit(False)) & ~blank(F.col("caption"))).withColumn("image_urls", distinct_images(urls)).where(F.size("image_urls") > 0)
    return ready.select(
        F.lit(schema_version).alias("schema_version"), F.coalesce(F.col("post_id").cast("string"), F.lit("")).alias("post_id"), text("permalink").alias("permalink"), F.lit(batch_seq).alias("batch_seq"), F.lit(True).alias("valid"),
        F.lit(None).cast("string").alias("invalid_reason"), text("author", "author_hint").alias("author"), strip(F.col("caption")).alias("caption"), "image_urls", F.col("image_urls").alias("cdn_urls"), posted.alias("posted_at"), F.lit("job1_passthrough").alias("enrich_source"), F.lit(run_id).alias("run_id"),
    )


def text_empty(ground_truth: Column, box_texts: Column) -> Column:
    """Neither the text nor any box's text holds anything but blanks."""
    return blank(ground_truth) & ~F.exists(F.coalesce(box_texts, F.array().cast("array<string>")), lambda t: ~blank(t))


def in_window(batch_seq: Column, lowest: int, highest: int, unknown: bool) -> Column:
    """Rows of the batches from lowest to highest; rows of no known batch (null or below 1) only if ``unknown``."""
    known = F.coalesce(batch_seq, F.lit(0)) >= 1
    return F.when(known, batch_seq.between(lowest, highest)).otherwise(F.lit(unknown))


def usable_image(url: Column, hosts: str = r"cdn|img|static|images", minimum: int = 100) -> Column:
    """An image address of a known kind of host, no video, and not of icon size."""
    side = F.coalesce(F.regexp_extract(url, r"[ps](\d{2,4})x(\d{2,4})", 1).try_cast("int"), F.lit(minimum))
    return url.rlike(r"^https?://") & url.rlike(hosts) & ~is_video(url) & ~url.rlike("emoji|avatar|icon|profile") & (side >= minimum)


def is_video(url: Column) -> Column:
    return F.lower(F.coalesce(url, F.lit(""))).rlike(r"\.(mp4|webm|mov|m3u8)(\?|$)|/videos?/")


def best_url(candidates: Column, junk: str = r"login|l\.php|/ads/|privacy", usable: str = r"/(posts|permalink)/\d+") -> Column:
    """The first usable address, else the first that is not junk, else empty."""
    clean = F.filter(candidates, lambda u: ~blank(u) & ~u.rlike(junk))
    return F.coalesce(F.get(F.filter(clean, lambda u: u.rlike(usable)), F.lit(0)), F.get(clean, F.lit(0)), F.lit(""))


def recheckable(reason: Column) -> Column:
    r = F.lower(strip(reason))
    return (r != "") & (r != EXHAUSTED) & (r.isin(*RECHECKABLE) | r.startswith("missing_"))


def recheck_candidates(posts: DataFrame, limit: int, max_attempts: int) -> DataFrame:
    """Invalid posts that may still be read, fewest attempts first."""
    tries = F.greatest(F.coalesce(F.col("recheck_attempts"), F.lit(0)), F.lit(0))
    ok = ~F.coalesce(F.col("recheck_exhausted"), F.lit(False)) & (tries < max(1, max_attempts)) & recheckable(F.col("invalid_reason"))
    return posts.where(ok).orderBy(tries, "post_id").limit(limit)


def retry_window(current: int, lowest: int | None = None, highest: int | None = None, backfilled: bool = False) -> tuple[int, int, bool]:
    """Bounds of the batches to retry, and whether rows of unknown batch count: all at first, later the newest."""
    if lowest is not None or highest is not None:
        low = lowest if lowest is not None else 1
        return low, highest if highest is not None else max(low, current), False
    return (current, current, False) if backfilled else (1, current, True)


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of lowest order of each key."""
    kept = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.col(order)).alias("r"))
    return kept.select("r.*")


def new_rows(batch: DataFrame, seen: DataFrame, key: str, order: str, skip_seen: bool = True) -> DataFrame:
    """Rows whose key was not seen, the first of each key; with skip_seen off, all rows."""
    if not skip_seen:
        return batch
    return first_per_key(batch, key, order).join(seen.select(key).distinct(), key, "left_anti").select(*batch.columns)


def union_seen(key: str, *sources: DataFrame) -> DataFrame:
    """Distinct keys of several seen tables."""
    out = sources[0].select(key)
    for s in sources[1:]:
        out = out.union(s.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def lookup_by_priority(rows: DataFrame, key: str, value: str, *sources: DataFrame) -> DataFrame:
    """rows with the value of the last source that has a non-blank one for the key."""
    ranked = [s.select(F.col(key), F.col(value), F.lit(i).alias("_rank")) for i, s in enumerate(sources)]
    one = ranked[0]
    for r in ranked[1:]:
        one = one.union(r)
    known = one.where(~blank(F.col(value))).groupBy(key).agg(F.max_by(value, F.struct("_rank", value)).alias(value))
    return rows.join(known, key, "left")


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Incoming rows replace whole rows of their key; of one key's incoming rows the last wins."""
    last = incoming.where(~blank(F.col(key).cast("string"))).groupBy(key).agg(F.max_by(F.struct(*incoming.columns), F.col(order)).alias("r")).select("r.*")
    return existing.join(last.select(key), key, "left_anti").select(*existing.columns).unionByName(last.select(*existing.columns))


def upsert_two_sided(valid: DataFrame, invalid: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of both sides after an upsert, in numeric order of their key: ``is_valid`` says on which side a row is.

    An incoming row takes its key's place on either side; of one key's incoming rows the
    last wins. Keys that are no number come first, as 0.
    """
    known = valid.withColumn("is_valid", F.lit(True)).unionByName(invalid.withColumn("is_valid", F.lit(False)))
    arrived = incoming.withColumn("is_valid", F.coalesce("is_valid", F.lit(False)))
    text = F.col(key).cast("string")
    number = F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return upsert(known.withColumn(order, F.lit(None).cast(incoming.schema[order].dataType)) if order not in known.columns else known, arrived, key, order).orderBy(number, key)


def newest(key: str, at: str, *sources: DataFrame) -> DataFrame:
    """The row of latest time of each key; of equal times the later source's."""
    ranked = [s.withColumn("_rank", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for r in ranked[1:]:
        both = both.unionByName(r)
    columns = sources[0].columns
    return both.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(at, "_rank")).alias("r")).select("r.*")


def merge_fields(rows: DataFrame, key: str, order: str, plain: Sequence[str], lists: Sequence[str], status: str | None = None, images: Sequence[str] = (), without: dict[str, str] | None = None) -> DataFrame:
    """One record per key, field by field.

    plain: the last non-blank value; lists: the union in order; images: the same, one
    address of each base and no videos; ``without``: per list a plain field whose value
    leaves it (a story's own id its tiles). status never falls in rank; is_valid is kept
    once true; invalid_reason is the last one from before the record was valid (the
    first row's counts); first_seen_at is the earliest; attempts the most; exhausted if
    it ever was. Fields that the rows lack are left out. Rows of one order are taken by
    their values.
    """
    rows = rows.where(F.col(key).isNotNull())
    filled = lambda c, when=F.lit(True): F.max_by(F.col(c), F.when(~blank(F.col(c).cast("string")) & when, F.struct(F.col(order), F.col(c)))).alias(c)
    aggs = [filled(c) for c in plain if c != "invalid_reason"]
    ordered = lambda c: F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))
    union = lambda c: F.flatten(F.transform(ordered(c), lambda x: F.coalesce(x["v"], F.array().cast("array<string>"))))
    aggs += [F.array_distinct(union(c)).alias(c) for c in lists] + [distinct_images(union(c)).alias(c) for c in images]
    if status:
        rank = F.array_position(F.array(*map(F.lit, STATUS_RANK)), F.col(status))
        aggs.append(F.max_by(F.col(status), F.struct(rank, F.col(order))).alias(status))
    for name, f in (("is_valid", F.bool_or), ("recheck_exhausted", F.bool_or), ("recheck_attempts", F.max), ("first_seen_at", F.min)):
        if name in rows.columns:
            aggs.append(f(name).alias(name))
    if "invalid_reason" in rows.columns:
        if "is_valid" in rows.columns:
            turn = rows.groupBy(key).agg(F.min(order).alias("_first"), F.min(F.when(F.col("is_valid"), F.col(order))).alias("_valid"))
            rows = rows.join(turn, key)
            before = F.col("_valid").isNull() | (F.col(order) < F.col("_valid")) | (F.col(order) == F.col("_first"))
        else:
            before = F.lit(True)
        aggs.append(filled("invalid_reason", before))
    out = rows.groupBy(key).agg(*aggs)
    left = lambda c, f: F.filter(c, lambda x: ~F.coalesce(x == F.col(f), F.lit(False)))
    return out.withColumns({c: left(c, f) for c, f in (without or {}).items()})


def rekey(rows: DataFrame, story: str, tile: str) -> DataFrame:
    """Rows under their story's id; a tile whose story is known from any row moves there too."""
    known = rows.where(~blank(F.col(story)) & ~blank(F.col(tile))).groupBy(F.col(tile).alias("_tile")).agg(F.max(story).alias("_story"))
    joined = rows.join(known, rows[tile] == known["_tile"], "left")
    return joined.withColumn("key", F.coalesce(non_empty(F.col(story)), F.col("_story"), non_empty(F.col(tile)))).drop("_tile", "_story")


def distinct_images(urls: Column) -> Column:
    """Image addresses in order, one per address without its query, no videos."""
    kept = F.filter(F.transform(F.coalesce(urls, F.array().cast("array<string>")), strip), lambda u: (u != "") & ~is_video(u) & (url_base(u) != ""))
    bases = F.transform(kept, url_base)
    return F.filter(kept, lambda u, i: F.array_position(bases, url_base(u)) == i + 1)


def distinct_capped(values: Column, limit: int = 500) -> Column:
    return F.slice(F.array_distinct(F.filter(F.transform(values, strip), lambda x: x != "")), 1, limit)


def backfill(rows: DataFrame, known: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Blank values filled from known; label_backfill marks them. Of a key's known rows the last by ``order`` counts, of equal ones the greatest value."""
    last = F.struct(*([order] if order else []), value)
    k = known.groupBy(key).agg(F.max_by(value, last).alias("_known"))
    fill = blank(F.col(value)) & ~blank(F.col("_known"))
    return rows.join(k, key, "left").withColumn("label_backfill", fill).withColumn(value, F.when(fill, F.col("_known")).otherwise(F.col(value))).drop("_known")


def merge_sources(universe: DataFrame, fused: DataFrame, legacy: DataFrame, key: str, bag: Column, prefer: str = "fuse_first", warn_below: float = 0.70, order: str | None = None, side: Sequence[str] = ()) -> DataFrame:
    """One row per key of the universe from two label sources, with the ``side`` columns of the row that was chosen.

    Of a key's rows in a source the last by ``order`` counts, of equal ones the greatest
    text. ``bag`` scores the columns fuse_gt and legacy_gt; a pair below warn_below is flagged.
    """
    if prefer not in ("fuse_first", "legacy_first"):
        raise ValueError(f"unsupported prefer {prefer!r}")

    def one(df: DataFrame, name: str) -> DataFrame:
        last = df.groupBy(key).agg(F.max_by(F.struct("ground_truth", *side), F.struct(*([order] if order else []), "ground_truth")).alias("_r"))
        return last.select(key, strip(F.col("_r.ground_truth")).alias(f"{name}_gt"), F.col("_r").alias(f"_{name}"))

    rows = universe.join(one(fused, "fuse"), key, "left").join(one(legacy, "legacy"), key, "left").fillna("", ["fuse_gt", "legacy_gt"])
    has_fuse, has_legacy = F.col("fuse_gt") != "", F.col("legacy_gt") != ""
    first, second = ((has_fuse, "fuse"), (has_legacy, "legacy_ocr")) if prefer == "fuse_first" else ((has_legacy, "legacy_ocr"), (has_fuse, "fuse"))
    rows = rows.withColumn("gt_source", F.when(first[0], first[1]).when(second[0], second[1]).otherwise("pending"))
    of = lambda fuse, legacy: F.when(F.col("gt_source") == "fuse", fuse).when(F.col("gt_source") == "legacy_ocr", legacy)
    rows = rows.withColumn("ground_truth", F.coalesce(of(F.col("fuse_gt"), F.col("legacy_gt")), F.lit("")))
    rows = rows.withColumns({c: of(F.col(f"_fuse.{c}"), F.col(f"_legacy.{c}")) for c in side}).drop("_fuse", "_legacy")
    both = has_fuse & has_legacy
    return rows.withColumn("both_present", both).withColumn("bag_fuse_vs_legacy", F.when(both, bag)).withColumn("diverge_flag", F.coalesce(F.col("bag_fuse_vs_legacy") < warn_below, F.lit(False)))


def gaps(pages: DataFrame, labels: DataFrame, judged: DataFrame, key: str, require_both: bool = False) -> DataFrame:
    """Pages that lack a label or a judgement; with require_both, only those that lack both."""
    has = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    rows = pages.select(key).distinct().join(has(labels, "l"), key, "left").join(has(judged, "j"), key, "left")
    lack_l, lack_j = F.col("l").isNull(), F.col("j").isNull()
    return rows.where((lack_l & lack_j) if require_both else (lack_l | lack_j)).select(key, lack_l.alias("lacks_label"), lack_j.alias("lacks_judge"))


def set_difference_counts(have: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """One row (added, removed): keys wanted and not there, and the reverse."""
    a, b = have.select(key).distinct().withColumn("h", F.lit(1)), want.select(key).distinct().withColumn("w", F.lit(1))
    return a.join(b, key, "full").agg(F.count_if(F.col("h").isNull()).alias("added"), F.count_if(F.col("w").isNull()).alias("removed"))

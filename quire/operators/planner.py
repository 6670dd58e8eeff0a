"""Slice plans: chapters packed and split into slices of about a target number of pages.

Packing is a fold with little state, expressed with ``aggregate`` over a document's ordered chapters. Moving an unsafe boundary
changes the next slice's start, so boundary repair is a fold too. All run per document in Catalyst; no group leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.schemas import OVERSIZED, SLICE
from quire.session import cut

TARGET, HARD_MAX, MERGE_MIN = 20, 25, 6


def _slice(title, start, end, mode, reason, level, problem=None) -> Column:
    review = problem.isNotNull() if isinstance(problem, Column) else F.lit(problem is not None)
    kind = problem if isinstance(problem, Column) else F.lit(problem)
    return F.struct(title.alias("title"), start.alias("start_page"), end.alias("end_page"), (mode if isinstance(mode, Column) else F.lit(mode)).alias("split_mode"), F.array().cast("array<int>").alias("overlap_pages"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("boundary_reason"), kind.cast("string").alias("exception_type"), review.alias("manual_review_required"), level.alias("toc_level")).cast(SLICE)


def _pages(x: Column) -> Column:
    return x["end_page"] - x["start_page"] + 1


GROUP = "struct<titles:array<string>,start_page:int,end_page:int,level:int,count:int,large:boolean>"


def _group(c: Column, target: int) -> Column:
    return F.struct(F.array(c["title"]).alias("titles"), c["start_page"].alias("start_page"), c["end_page"].alias("end_page"), c["level"].alias("level"), F.lit(1).alias("count"), (_pages(c) > target).alias("large")).cast(GROUP)


def small_groups(chapters: Column, target: int = TARGET, least: int = MERGE_MIN) -> Column:
    """Chapters (array of title, start_page, end_page, level) greedily grouped: a group closes once two chapters reach ``least``
    pages, and never exceeds ``target``; a chapter over the target stands alone."""

    def step(groups, c):
        last = F.try_element_at(groups, F.lit(-1))
        full = (last["count"] >= 2) & (_pages(last) >= least)
        joins = F.coalesce(~last["large"] & ~full & (_pages(c) <= target) & (c["end_page"] - last["start_page"] + 1 <= target), F.lit(False))
        more = F.struct(F.concat(last["titles"], F.array(c["title"])).alias("titles"), last["start_page"].alias("start_page"), c["end_page"].alias("end_page"), F.least(last["level"], c["level"]).alias("level"), (last["count"] + 1).alias("count"), F.lit(False).alias("large")).cast(GROUP)
        return F.when(joins, F.concat(F.slice(groups, 1, F.greatest(F.size(groups) - 1, F.lit(0))), F.array(more))).otherwise(F.concat(groups, F.array(_group(c, target))))

    return F.aggregate(chapters, F.array().cast(f"array<{GROUP}>"), step)


def packed_sections(sections: Column, most: int = HARD_MAX) -> Column:
    """Sections packed into slices of at most ``most`` pages; a longer one stands alone and is flagged."""

    def step(groups, s):
        last = F.try_element_at(groups, F.lit(-1))
        joins = F.coalesce(~last["large"] & (_pages(s) <= most) & (s["end_page"] - last["start_page"] + 1 <= most), F.lit(False))
        more = F.struct(F.concat(last["titles"], F.array(s["title"])).alias("titles"), last["start_page"].alias("start_page"), s["end_page"].alias("end_page"), F.least(last["level"], s["level"]).alias("level"), (last["count"] + 1).alias("count"), F.lit(False).alias("large")).cast(GROUP)
        return F.when(joins, F.concat(F.slice(groups, 1, F.greatest(F.size(groups) - 1, F.lit(0))), F.array(more))).otherwise(F.concat(groups, F.array(_group(s, most))))

    groups = F.aggregate(sections, F.array().cast(f"array<{GROUP}>"), step)
    title = lambda g: F.when(g["count"] == 1, g["titles"][0]).otherwise(F.concat(g["titles"][0], F.lit(" - "), F.element_at(g["titles"], -1)))
    return F.transform(groups, lambda g: _slice(title(g), g["start_page"], g["end_page"], "section", "section_boundary", g["level"], F.when(g["large"], F.lit("oversized_section"))))


def nearest(safe: Column, low: Column, want: Column, high: Column, forward: bool = False) -> Column:
    """The safe page of [low, high] nearest to ``want``; of two, the earlier, or (forward) the later. Null if there is none."""
    side = lambda p: (p < want if forward else p > want).cast("int")
    fit = F.filter(safe, lambda p: (p >= low) & (p <= high))
    return F.array_min(F.transform(fit, lambda p: F.struct(F.abs(p - want).alias("d"), side(p).alias("s"), p.alias("p"))))["p"]


def first_safe(safe: Column, low: Column, high: Column) -> Column:
    return F.array_min(F.filter(safe, lambda p: (p >= low) & (p <= high)))


def physical(title: Column, start: Column, end: Column, level: Column, safe: Column, target: int = TARGET, most: int = HARD_MAX) -> Column:
    """Slices of a chapter without structure: each ends at the safe page nearest to its target, else at the first safe page beyond
    the hard maximum (flagged), else with the chapter (flagged)."""

    def piece_from(at):
        left = end - at + 1
        want, upper = at + (target - 1), F.least(at + (most - 1), end - 1)
        near, far = nearest(safe, at, want, upper), first_safe(safe, upper + 1, end - 1)
        whole = left <= most
        to = F.when(whole, end).otherwise(F.coalesce(near, far, end))
        reason = F.when(whole, F.when(left <= target, "fallback_physical").otherwise("semantic_integrity")).otherwise(F.when(near == want, "page_limit").otherwise("semantic_integrity"))
        problem = F.when(whole | near.isNotNull(), F.lit(None)).otherwise(F.when(far.isNotNull(), "oversized_semantic_block").otherwise("oversized_section"))
        return _slice(title, at, to, "physical", reason, level, problem)

    def step(state, _):
        done = state["at"] > end
        piece = piece_from(state["at"])
        return F.when(done, state).otherwise(F.struct((piece["end_page"] + 1).alias("at"), F.concat(state["out"], F.array(piece)).alias("out")))

    rounds = F.sequence(F.lit(0), F.greatest(end - start, F.lit(0)))
    return F.aggregate(rounds, F.struct(start.alias("at"), F.array().cast(f"array<{SLICE}>").alias("out")), step)["out"]


def _with(s: Column, **changes: Column) -> Column:
    fields = [x.split(":")[0] for x in "title:start_page:end_page:split_mode:overlap_pages:boundary_reason:exception_type:manual_review_required:toc_level".split(":")]
    return F.struct(*((changes[f] if f in changes else s[f]).alias(f) for f in fields)).cast(SLICE)


def moved_boundaries(plans: Column, safe: Column, starts: Column, last_page: Column, most: int = HARD_MAX) -> Column:
    """Unsafe boundaries that no chapter or section start justifies move to a safe page, the later of two; the next slice starts
    behind it."""

    def step(state, nxt):
        cur = F.element_at(state, -1)
        b = cur["end_page"]
        settled = (b >= nxt["end_page"]) | (b >= last_page) | F.array_contains(safe, b) | (F.array_contains(starts, nxt["start_page"]) & (b + 1 == nxt["start_page"]))
        upper = nxt["end_page"] - 1
        normal = F.least(cur["start_page"] + (most - 1), upper)
        to = F.coalesce(nearest(safe, cur["start_page"], b, normal, forward=True), first_safe(safe, normal + 1, upper))
        large = to - cur["start_page"] + 1 > most
        stuck = _with(cur, boundary_reason=F.lit("semantic_integrity"), exception_type=F.coalesce(cur["exception_type"], F.lit("oversized_semantic_block")), manual_review_required=F.lit(True))
        shifted = _with(cur, end_page=to, boundary_reason=F.lit("semantic_integrity"), exception_type=F.when(large, F.coalesce(cur["exception_type"], F.lit("oversized_semantic_block"))).otherwise(cur["exception_type"]), manual_review_required=cur["manual_review_required"] | large)
        after = _with(nxt, start_page=to + 1, boundary_reason=F.lit("semantic_integrity"))
        kept = F.slice(state, 1, F.greatest(F.size(state) - 1, F.lit(0)))
        return F.when(settled, F.concat(state, F.array(nxt))).when(to.isNull(), F.concat(kept, F.array(stuck, nxt))).otherwise(F.concat(kept, F.array(shifted, after)))

    return F.when(F.size(plans) > 0, F.aggregate(F.slice(plans, 2, F.greatest(F.size(plans) - 1, F.lit(0))), F.slice(plans, 1, 1), step)).otherwise(plans)


def title_tokens(title: Column) -> Column:
    """Parts of a joined title that are long enough to be looked for: two characters, four if all are ASCII."""
    parts = F.transform(F.split(title, r" \+ "), F.trim)
    return F.filter(parts, lambda t: F.length(t) >= F.when(t.rlike(r"[^\x00-\x7F]"), 2).otherwise(4))


def titles_meet(current: Column, following: Column, next_text: Column, this_text: Column) -> Column:
    return F.exists(title_tokens(current), lambda t: F.contains(next_text, t)) | F.exists(title_tokens(following), lambda t: F.contains(this_text, t))


def with_overlap(plans: Column, starts: Column, texts: Column, most: int = HARD_MAX) -> Column:
    """Neighbouring slices share the page where a structure starts or a title is named; texts: map of page to text."""
    page = lambda n: F.coalesce(F.try_element_at(texts, n), F.lit(""))

    def shares(cur, nxt):
        at = nxt["start_page"]
        return F.coalesce((at > cur["end_page"]) & (F.array_contains(starts, at) | titles_meet(cur["title"], nxt["title"], page(at), page(cur["end_page"]))), F.lit(False))

    def one(cur, i):
        before, after = F.get(plans, i - 1), F.get(plans, i + 1)
        to_next = after.isNotNull() & shares(cur, after)
        to_last = (i > 0) & before.isNotNull() & shares(before, cur)
        pages = F.concat(cur["overlap_pages"], F.when(to_last, F.array(cur["start_page"])).otherwise(F.array().cast("array<int>")), F.when(to_next, F.array(after["start_page"])).otherwise(F.array().cast("array<int>")))
        end = F.when(to_next, after["start_page"]).otherwise(cur["end_page"])
        large = to_next & (end - cur["start_page"] + 1 > most)
        return _with(cur, end_page=end, overlap_pages=F.array_distinct(pages), exception_type=F.when(large, F.coalesce(cur["exception_type"], F.lit("oversized_semantic_block"))).otherwise(cur["exception_type"]), manual_review_required=cur["manual_review_required"] | large)

    return F.transform(plans, one)


def settled_flags(plans: Column, most: int = HARD_MAX) -> Column:
    """Slices that fit after all lose their oversize flag."""
    fits = lambda s: (_pages(s) <= most) & F.coalesce(s["exception_type"].isin(*OVERSIZED), F.lit(False))
    return F.transform(plans, lambda s: F.when(fits(s), _with(s, exception_type=F.lit(None).cast("string"), manual_review_required=F.lit(False))).otherwise(s))


def plan(documents: DataFrame, target: int = TARGET, most: int = HARD_MAX, least: int = MERGE_MIN) -> DataFrame:
    """Slices of each document: doc_id, pos and the fields of a slice.

    documents: doc_id, last_page, chapters array<struct<title,start_page,end_page,level,sections array<struct<title,start_page,
    end_page,level>>>>, safe array<int> (pages after which a cut is safe), texts map<int,string>."""
    rows = documents.withColumn("groups", small_groups(F.transform("chapters", lambda c: F.struct(c["title"], c["start_page"], c["end_page"], c["level"])), target, least))
    rows = cut(rows)
    one = lambda g: F.get(F.filter("chapters", lambda c: (c["start_page"] == g["start_page"]) & (c["end_page"] == g["end_page"])), F.lit(0))

    def slices(g):
        title = F.array_join(g["titles"], " + ")
        whole = _slice(title, g["start_page"], g["end_page"], F.when(g["count"] > 1, "merge").otherwise("chapter"), "chapter_boundary", g["level"])
        packs = packed_sections(F.coalesce(one(g)["sections"], F.array().cast("array<struct<title:string,start_page:int,end_page:int,level:int>>")), most)
        useless = (F.size(packs) == 1) & (packs[0]["start_page"] == g["start_page"]) & (packs[0]["end_page"] == g["end_page"]) & (_pages(packs[0]) > most)
        split = F.when((F.size(packs) > 0) & ~useless, packs).otherwise(physical(title, g["start_page"], g["end_page"], g["level"], F.col("safe"), target, most))
        return F.when((g["count"] > 1) | (_pages(g) <= most), F.array(whole)).otherwise(split)

    rows = cut(rows.withColumn("base", F.flatten(F.transform("groups", slices))))  # each step reads the one before it many times
    big = F.filter("chapters", lambda c: _pages(c) > most)
    tails = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    starts = F.concat(F.transform(tails(F.col("chapters")), lambda c: c["start_page"]), F.flatten(F.transform(big, lambda c: F.transform(tails(F.coalesce(c["sections"], F.array().cast("array<struct<title:string,start_page:int,end_page:int,level:int>>"))), lambda s: s["start_page"]))))
    rows = rows.withColumn("starts", starts)
    rows = cut(rows.withColumn("base", moved_boundaries(F.col("base"), F.col("safe"), F.col("starts"), F.col("last_page"), most)))
    rows = rows.withColumn("base", with_overlap(F.col("base"), F.col("starts"), F.coalesce("texts", F.create_map().cast("map<int,string>")), most))
    return rows.select("doc_id", F.posexplode(settled_flags(F.col("base"), most)).alias("pos", "s")).select("doc_id", (F.col("pos") + 1).alias("pos"), "s.*")


def slice_names(slices: DataFrame) -> DataFrame:
    """slice_file of each slice: title and pages, illegal characters replaced; from the second equal name on with a number."""
    from pyspark.sql import Window as W

    from quire.functions import text as T

    base = F.format_string("%s（%d-%d）", T.safe_name(F.col("title"), "未命名章节", dots=False), "start_page", "end_page")
    n = F.row_number().over(W.partitionBy("doc_id", "base").orderBy("pos"))
    named = slices.withColumn("base", base).withColumn("n", n)
    return named.withColumn("slice_file", F.concat("base", F.when(F.col("n") > 1, F.format_string("_%02d", "n")).otherwise(""), F.lit(".pdf"))).drop("base", "n")

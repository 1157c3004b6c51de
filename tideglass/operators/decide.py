"""Decision tables over features: official sites, address conflicts, homepage policy, final status, confidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideglass.functions import address as A
from tideglass.functions.text import blank


def official_signal(host_token: Column, strong_host: Column, domain: Column, name: Column, address: Column, evidence: Column) -> Column:
    """A strong domain with a name, an address or evidence of 9; or a medium one with more."""
    strong, medium = host_token | strong_host | (domain >= 4), domain >= 3
    return F.coalesce((strong & (name | address | (evidence >= 9))) | (medium & name & (address | (evidence >= 7))) | (medium & (evidence >= 11)), F.lit(False))


def selection_score(official: Column, confidence: Column, domain: Column, evidence: Column, host_token: Column, strong_host: Column, name: Column, directory: Column, least: float = 0.6) -> Column:
    """The order in which candidate sites are chosen: a confident verdict first, directories last."""
    conf = F.coalesce(confidence, F.lit(0.0))
    verdict = F.when(official & (conf >= least), 1000.0 + conf * 100).when(official, conf * 10).when(~official, -200.0).otherwise(0.0)
    bonus = sum((F.when(c, v).otherwise(0.0) for c, v in ((host_token, 20.0), (strong_host, 12.0), (name, 10.0), (directory, -500.0))), F.lit(0.0))
    return verdict + domain * 5.0 + evidence * 2.0 + bonus


def homepage_policy(homepage: Column, flag: Column, source: Column, score: Column, domain: Column, host_token: Column, name: Column, address: Column, hint: Column, profile: Column, evidence: Column) -> Column:
    """STRUCT(homepage, source, score, domain, dropped): a provisional site of weak signals is dropped, all else stays."""
    provisional = ~blank(homepage) & (F.coalesce(flag, F.lit(0)) == 0) & source.rlike("^(ai_)?provisional")
    strong = (domain >= 4) | ((host_token | name) & (domain >= 3)) | (address & (domain >= 4)) | hint | profile | (evidence >= 8)
    dropped = F.coalesce(provisional & ~F.coalesce(strong, F.lit(False)), F.lit(False))
    pick = lambda c, v: F.when(dropped, F.lit(v)).otherwise(c)
    return F.struct(pick(F.coalesce(homepage, F.lit("")), "").alias("homepage"), pick(source, "").alias("source"), pick(score, 0.0).alias("score"), pick(domain, 0).alias("domain"), dropped.alias("dropped"))


PROFILE = ("/company", "/about", "/profile", "/overview", "/corporate")
CONTACT = ("/contact", "/inquiry", "/toiawase", "お問い合わせ", "お問合せ", "問合せ")


def _has(c: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.lower(c), F.lit(w))
    return F.coalesce(out, F.lit(False))


def address_decision(listed: Column, found: Column, flag: Column, score: Column, source: Column, confidence: Column, evidence: Column, address_url: Column, phone_url: Column, phone: Column, status: Column, least: float = 0.88) -> Column:
    """STRUCT(overwrite, level, reason, status): whether an address from a site may replace the listed one.

    Within one prefecture a strong source may replace a poorer address. Another
    prefecture needs the head office named, the phone on the same page and high
    confidence, or a listed address too poor against a rich one, or a rich one
    from a profile page of a sure site; else it goes to review.
    """
    a, b = F.coalesce(listed, F.lit("")), F.coalesce(found, F.lit(""))
    strong = F.coalesce((flag == 1) & (score >= 4.0), F.lit(False))
    kind = F.lower(F.coalesce(source, F.lit("")))
    pa, pb = A.prefecture(a), A.prefecture(b)
    differs = pa.isNotNull() & pb.isNotNull() & (pa != pb)
    za, zb, ca, cb = A.has_zip(a), A.has_zip(b), A.has_city(a), A.has_city(b)
    sure = F.coalesce(confidence >= least, F.lit(False))
    head = _has(evidence, ("本社所在地", "本店所在地", "本社", "本店"))
    same_page = ~blank(phone) & ~blank(address_url) & F.coalesce(address_url == phone_url, F.lit(False))
    page_ok = ~(_has(address_url, CONTACT) & ~_has(address_url, PROFILE))
    own = kind.isin("rule", "official")
    richer = (a == "") | (F.length(b) > F.length(a)) | (zb & ~za) | (cb & ~ca)
    within = (strong | own) & richer & ~(pa.isNotNull() & pb.isNull() & (a != ""))
    named = strong & (kind == "ai") & sure & head & same_page & page_ok
    poor = (~za | ~ca) & strong & page_ok & zb & cb & (same_page | head | own | ((kind == "ai") & sure))
    profile = strong & own & page_ok & _has(address_url, PROFILE) & zb & cb & (same_page | head | (F.length(b) >= F.length(a)))
    over = (b != "") & F.when(differs, named | poor | profile).otherwise(within)
    clash = differs & (b != "")
    level = F.when(clash & over, "pref_mismatch_overwritten").when(clash, "pref_mismatch").otherwise("")
    review = clash & ~over
    reason = F.when(review, "pref_mismatch_no_strong_hq_evidence").otherwise("")
    return F.struct(over.alias("overwrite"), level.alias("level"), reason.alias("reason"), F.when(review & (status == "done"), "review").otherwise(status).alias("status"))


def confidence(need_phone: Column, need_address: Column, phone_ok: Column, address_ok: Column, before: Column) -> Column:
    """How well what was expected was found again: 1, 0.85, 0.75 or 0.45; at least 0.6 where nothing was expected."""
    need = need_phone.cast("int") + need_address.cast("int")
    met = phone_ok.cast("int") + address_ok.cast("int")
    every = (~need_phone | phone_ok) & (~need_address | address_ok)
    return F.when(need == 0, F.greatest(F.coalesce(before, F.lit(0.0)), F.lit(0.6))).when(every, F.when(need == 2, 1.0).otherwise(0.85)).when(met >= 1, 0.75).otherwise(0.45)


def final_status(homepage: Column, candidates: Column, timed_out: Column, target: Column, phone_ok: Column, address_ok: Column, domain: Column, flag: Column, source: Column, chosen_by_model: Column, compatible: Column, force_review: Column) -> Column:
    """done, review or no_homepage: a site is done only if it is sure and nothing expected was missed."""
    have, met = ~blank(homepage), phone_ok | address_ok
    weak = target & ~met & (domain < 5)
    doubtful = (domain != 0) & (domain < 4) & source.isin("ai", "rule")
    sure = (flag == 1) & ((domain >= 4) | ((source == "verify_promote") & (domain >= 3))) & (chosen_by_model | compatible) & (~target | met)
    review = timed_out | (~have & candidates) | (have & (weak | doubtful | ~F.coalesce(sure, F.lit(False)))) | force_review
    return F.when(review, "review").when(have, "done").otherwise("no_homepage")


def flag_skips(official: Column, source: Column, confidence: Column, least: float = 0.6) -> Column:
    """A stored negative verdict skips a URL, but one of a model only if it was confident."""
    return F.coalesce(~official & (~F.lower(source).startswith("ai") | (F.coalesce(confidence, F.lit(0.0)) >= least)), F.lit(False))

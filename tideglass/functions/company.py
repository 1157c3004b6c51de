"""What a company's name, phone and texts become before they are compared or shown to a model. Native, but for forms' HTML."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from . import urls
from .address import address, looks_like
from .names import entity_kinds
from .text import blank, nfkc, paragraphs_topk, sanitized, squeezed, stripped

#: Letters and digits as they are spelled in katakana.
SPELLED = {
    "ダブリュー": "w", "エックス": "x", "ジェー": "j", "ジェイ": "j", "シー": "c", "スリー": "3", "ツー": "2", "ワイ": "y", "ゼット": "z", "ビー": "b", "ディー": "d", "エム": "m", "エヌ": "n", "ピー": "p", "キュー": "q",
    "エル": "l", "エフ": "f", "エイチ": "h", "エー": "a", "イー": "e", "アール": "r", "エス": "s", "ティー": "t", "ユー": "u", "ブイ": "v", "ズィー": "z", "アイ": "i", "ケー": "k", "ダブル": "w", "ゼロ": "0", "オー": "o",
}
#: Numbers and colours in Roman letters.
TRANSLATED = {
    "ichi": "one", "ni": "two", "san": "three", "yon": "four", "shi": "four", "go": "five", "roku": "six", "nana": "seven", "shichi": "seven", "hachi": "eight", "kyu": "nine", "ku": "nine", "ju": "ten", "juu": "ten",
    "hyaku": "hundred", "sen": "thousand", "man": "man", "oku": "oku", "aka": "red", "ao": "blue", "midori": "green", "kuro": "black", "shiro": "white",
}
#: Ends of hosts.
ENTITY_SUFFIXES = {"gov": (".lg.jp", ".go.jp"), "edu": (".ac.jp", ".ed.jp"), "med": (".or.jp", ".go.jp"), "npo": (".or.jp",)}
OFFICIAL_ENDS = (".co.jp", ".or.jp", ".ac.jp", ".ed.jp", ".go.jp", ".lg.jp", ".gr.jp", ".jp", ".com", ".net", ".org", ".biz", ".info", ".co")
ALLOWED_HOSTS = ("big-advance.site",)
PROFILE_HINTS = ("company", "about", "profile", "corporate", "overview", "info", "information", "gaiyou", "gaiyo", "kaisya", "outline", "companyinfo", "company-information")
#: Where an address field goes on with something else.
ADDRESS_ENDS = ("Google", "営業時間", "設立", "資本金", "代表者", "代表番号", "代表", "代表取締役", "執行役員", "役員", "取締役", "管理本部", "電話", "TEL", "ＴＥＬ", "FAX", "メール", "E-mail", "お問い合わせ", "メ-ルでのお問い合わせ", "■")
#: Words that no description may hold, and how none may begin.
NOT_DESCRIBING = ("お問い合わせ", "お問合せ", "採用情報", "求人", "ニュース", "お知らせ", "アクセス", "所在地", "電話番号", "メール")
GENERAL_INQUIRY = ("お問い合わせ", "問合せ", "問い合わせ", "ご相談", "ご質問")
RECRUITING = ("応募", "求人", "採用", "リクルート", "エントリー")
#: A number that may be a phone's, with its label.
_NUMBER = r"(?i)(?:TEL|電話|☎|℡)?\s*0[0-9]{1,4}[-‐―－ー]?[0-9]{1,4}[-‐―－ー]?[0-9]{3,4}"


def ascii_tokens(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z0-9]{2,}"), F.lit(0)), F.lower)


def spelled_letters(c: Column) -> Column:
    """Of each run of katakana the letters that it spells, where there are two or more."""
    letters = F.create_map(*[x for k, v in SPELLED.items() for x in (F.lit(k), F.lit(v))])
    longest_first = "|".join(sorted(SPELLED, key=len, reverse=True))
    runs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[ァ-ヶー]+"), F.lit(0))
    words = F.transform(runs, lambda r: F.array_join(F.transform(F.regexp_extract_all(r, F.lit(longest_first), F.lit(0)), lambda k: F.element_at(letters, k)), ""))
    return F.filter(words, lambda w: F.length(w) >= 2)


def tokens(name: Column, roman: Column | None = None) -> Column:
    """The distinct words that a company's host may hold, in order: those in Roman letters, runs of one to three words of ``roman`` (the name's transcription, by a tool outside), spelled letters, and translations."""
    roman = F.lower(F.coalesce(roman, F.lit(""))) if roman is not None else F.lit("")
    parts = F.filter(F.split(roman, "[^a-z0-9]+"), lambda p: F.length(p) >= 2)
    runs = F.flatten(F.transform(parts, lambda _, i: F.transform(F.sequence(F.lit(1), F.least(F.lit(3), F.size(parts) - i)), lambda n: F.array_join(F.slice(parts, i + 1, n), ""))))
    joined = F.filter(F.concat(F.array(F.regexp_replace(roman, "[^a-z0-9]", "")), F.coalesce(runs, F.array().cast("array<string>"))), lambda x: F.length(x) >= 4)
    every = F.concat(ascii_tokens(name), ascii_tokens(roman), joined, spelled_letters(name))
    other = F.flatten(F.transform(every, lambda t: F.array(*[F.when(F.contains(t, F.lit(k)), F.replace(t, F.lit(k), F.lit(v))) for k, v in TRANSLATED.items()])))
    return F.array_distinct(F.concat(every, F.filter(other, lambda t: F.length(t) >= 4)))


def official_host(url: Column) -> Column:
    """STRUCT(host, path, allowed_end, allowed_host, google_site)."""
    h, p = urls.host(url), F.lower(urls.path(url))
    ends = F.lit(False)
    for e in OFFICIAL_ENDS:
        ends = ends | h.endswith(e)
    return F.struct(h.alias("host"), p.alias("path"), ends.alias("allowed_end"), urls.host_in(h, ALLOWED_HOSTS).alias("allowed_host"), ((h == "sites.google.com") | (h.endswith(".google.com") & p.contains("sites"))).alias("google_site"))


def entity_host(name: Column, url: Column) -> Column:
    """Whether the host ends as those of the name's kind of body do."""
    h, kinds, out = urls.netloc(url), entity_kinds(name), F.lit(False)
    for kind, ends in ENTITY_SUFFIXES.items():
        for e in ends:
            out = out | (F.array_contains(kinds, kind) & h.endswith(e))
    return F.coalesce(out, F.lit(False))


def profile_url(name: Column, url: Column, words: Column, host_token: Column) -> Column:
    """Whether a URL may be the company's own page about itself: its host is of the name's kind, or holds one of the ``words`` (``host_token``), and its path or score speaks for it."""
    score, own = urls.domain_score(url, words), entity_host(name, url)
    hint = urls.has_segment(urls.path(url), PROFILE_HINTS)
    body = F.array_contains(entity_kinds(name), "gov") & ~own
    return F.coalesce(
        F.when(body, False).when((F.size(words) == 0) & ~own, hint & (score >= 2)).when(own, hint | host_token | (score >= 1)).otherwise(host_token & (hint | (score >= 1))),
        F.lit(False),
    )


def without_phones(c: Column) -> Column:
    """STRUCT(text, numbers): the text without numbers of 10 to 12 digits that begin with 0, blanks folded, and how many there were."""
    s = F.coalesce(c, F.lit(""))
    found, between = F.regexp_extract_all(s, F.lit(_NUMBER), F.lit(0)), F.split(s, _NUMBER, -1)
    is_phone = lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")).between(10, 12)
    kept = F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.when(is_phone(F.get(found, i)), F.lit(" ")).otherwise(F.get(found, i)), F.lit(""))))
    return F.struct(squeezed(F.array_join(kept, "")).alias("text"), F.size(F.filter(found, is_phone)).alias("numbers"))


def holds_number(text: Column, phone: Column, least: int = 1, separators: str = "[^0-9]") -> Column:
    """Whether the phone's digits follow each other in the text, whatever of ``separators`` is between; false below ``least`` digits."""
    d = F.regexp_replace(F.coalesce(phone, F.lit("")), "[^0-9]", "")
    return F.coalesce((F.length(d) >= least) & F.contains(F.regexp_replace(text, separators, ""), d), F.lit(False))


def labelled_phone(c: Column) -> Column:
    """area-exchange-line of the first number behind labels and brackets, null if there is none."""
    s = F.regexp_replace(F.regexp_replace(nfkc(c), "[‐―－ー]+", "-"), r"（.*?）|(?i:TEL)[:：]\s*", "")
    part = lambda n: F.regexp_extract(s, r"(0\d{1,4})-?(\d{1,4})-?(\d{3,4})", n)
    return F.when(part(1) != "", F.concat_ws("-", part(1), part(2), part(3)))


def input_address(c: Column) -> Column:
    """The address in a field that may hold several, or more than an address: the first one, cut where something else begins; blank if it is none."""
    s = squeezed(F.coalesce(c, F.lit("")))
    marks = F.regexp_extract_all(s, F.lit(r"〒\s*[0-9]{3}-[0-9]{4}"), F.lit(0))
    first = F.regexp_extract(s, r"(〒\s*[0-9]{3}-[0-9]{4}.*?)〒\s*[0-9]{3}-[0-9]{4}", 1)
    s = F.when(F.size(marks) >= 2, F.trim(first)).otherwise(s)
    heads = []
    for end in ADDRESS_ENDS:
        head = F.trim(F.substring_index(s, end, 1))
        heads.append(F.when(F.contains(s, F.lit(end)) & (F.length(head) >= 10) & looks_like(head), head))
    s = F.trim(F.regexp_replace(F.coalesce(*heads, s), r"[()（）\[\]]", ""))
    return F.when(looks_like(F.coalesce(address(s), F.lit(""))), s).otherwise("")


def accepted_description(current: Column, candidate: Column, most: int = 160) -> Column:
    """The candidate, cut, if it describes a company and differs; else what there is."""
    s, low = stripped(candidate), F.lower(stripped(candidate))
    never = urls.has_segment(s, NOT_DESCRIBING) | low.rlike("^(contact|recruit|news)") | low.rlike("https?://")
    cut = F.when(F.length(s) > most, F.rtrim(F.substring(s, 1, most))).otherwise(s)
    return F.when(F.coalesce((F.length(s) >= 10) & ~never & ~s.contains("�"), F.lit(False)), cut).otherwise(current)


def model_text(blocks: list[Column], most: int = 4000) -> Column:
    """Blocks cleaned of HTML's remains, the empty ones aside, parted by a blank line and cut."""
    clean = [F.when(F.length(b) >= 2, b) for b in (sanitized(b) for b in blocks)]
    return F.substring(F.array_join(F.array_compact(F.array(*clean)), "\n\n"), 1, most)


def industry_text(description: Column, tags: Column, profile: list[Column], extra: list[Column] = (), most: int = 9000) -> Column:
    """A description, tags, profile and evidence blocks as one text, a marked line each, cut."""
    marked = lambda mark, b: F.when(F.length(b) >= 2, F.concat(F.lit(mark), b))
    named = F.transform(F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: ~blank(t)), lambda t: F.concat(F.lit("[PRIORITY_TAG]"), stripped(t)))
    rows = [F.array(marked("[PRIORITY_DESCRIPTION]", sanitized(description))), named]
    for mark, blocks in (("COMPANY_PROFILE", profile), ("EVIDENCE", extra)):
        rows += [F.array(marked(f"[{mark}_{i}]", sanitized(b))) for i, b in enumerate(blocks, 1)]
    return F.substring(F.array_join(F.array_compact(F.concat(*rows)), "\n"), 1, most)


def page_blocks(pages: Column, keywords: list[str], k: int = 3, chars: int = 1200, most: int | None = 10) -> Column:
    """Of ARRAY<STRUCT(text, meta)> the distinct blocks in order: each page's ``k`` best paragraphs, cut, and its own description."""
    both = F.flatten(F.transform(pages, lambda p: F.array(F.substring(paragraphs_topk(F.coalesce(p["text"], F.lit("")), keywords, k), 1, chars), F.coalesce(p["meta"], F.lit("")))))
    out = F.array_distinct(F.filter(F.transform(both, stripped), lambda b: b != ""))
    return out if most is None else F.slice(out, 1, most)


def is_contact_page(page_type: Column, html: Column, text: Column) -> Column:
    """A contact page with a form, or with words of inquiry."""
    asks = F.coalesce(text, F.lit("")).rlike("お問い合わせ|お問合せ|問い合わせ")
    return F.coalesce((page_type == "ACCESS_CONTACT") & (F.lower(F.coalesce(html, F.lit(""))).contains("<form") | asks), F.lit(False))


class Forms(HTMLParser):
    """The words of a page's forms (labels, options, fields' names, values and hints), how many fields they have and where they go."""

    def __init__(self, source: str | None):
        super().__init__(convert_charrefs=True)
        self.words: list[list[str]] = []
        self.inputs: list[int] = []
        self.actions: list[str] = []
        self.title = ""
        self._in: list[str] = []
        try:
            self.feed(source or "")
            self.close()
        except (AssertionError, ValueError):
            pass

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == "form":
            self.words.append([])
            self.inputs.append(0)
            self.actions.append((at.get("action") or "").strip())
        if tag in ("form", "label", "option", "title"):
            self._in.append(tag)
        elif tag in ("input", "textarea", "select") and "form" in self._in:
            self.inputs[-1] += 1
            self.words[-1] += [at[k] for k in ("name", "value", "placeholder", "aria-label") if at.get(k)]

    def handle_endtag(self, tag):
        if tag in self._in:
            while self._in and self._in.pop() != tag:
                pass

    def handle_data(self, data):
        if "title" in self._in:
            self.title = self.title or data.strip()
        elif "form" in self._in and self._in[-1] in ("label", "option"):
            self.words[-1].append(data.strip())

    def choices(self) -> tuple[bool, bool]:
        """Whether a form takes general inquiries, and whether forms take applications alone."""
        blobs = [" ".join(unicodedata.normalize("NFKC", " ".join(w)).split()) for w in self.words]
        general = any(t in b for b in blobs for t in GENERAL_INQUIRY)
        return general, not general and any(t in b for b in blobs for t in RECRUITING)


_FORM = StructType([StructField("forms", IntegerType()), StructField("inputs", IntegerType()), StructField("general", BooleanType()), StructField("recruit_only", BooleanType()), StructField("mail", BooleanType()), StructField("hosts", ArrayType(StringType())), StructField("title", StringType())])


@F.pandas_udf(_FORM)
def forms(url: pd.Series, html: pd.Series) -> pd.DataFrame:
    """A page's forms: how many, the first five's fields and the hosts that they go to, whom they are for; a mail link; the title."""
    rows = []
    for u, source in zip(url, html, strict=True):
        f = Forms(source)
        hosts = []
        for action in filter(None, f.actions[:5]):
            try:
                host = urlsplit(urljoin(u or "", action)).netloc.lower()
            except ValueError:
                continue
            if host and host not in hosts:
                hosts.append(host)
        rows.append((len(f.words), sum(f.inputs[:5]), *f.choices(), "mailto:" in (source or "").lower(), hosts, f.title))
    return pd.DataFrame(rows, columns=_FORM.names)


def contact_signals(homepage: Column, url: Column, form: Column) -> Column:
    """What a model is told of a contact page: ten facts, of two URLs and the page's ``forms``."""
    a, b = urls.netloc(homepage), urls.netloc(url)
    facts = {
        "same_host": a == b, "same_reg_domain": urls.registrable(urls.host(homepage)) == urls.registrable(urls.host(url)), "has_form": form["forms"] > 0, "form_count": form["forms"], "input_count": form["inputs"],
        "action_hosts": F.array_join(F.slice(form["hosts"], 1, 3), ","), "general_inquiry_option": form["general"], "recruit_only": form["recruit_only"], "email_present": form["mail"], "title": form["title"],
    }
    return F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in facts.items()])

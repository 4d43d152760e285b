"""Text rules as column expressions: tags, quotes, owners, addresses, dates in words, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters folded before quotes are compared.
FOLD_FROM, FOLD_TO = "‘’“”–—×", "''\"\"--x"
#: Words that say nothing about who owns a parcel, and those that say little.
STOP_WORDS = (
    "et", "al", "etal", "etux", "llc", "lp", "llp", "ltd", "inc", "co", "corp", "tr", "trust", "trustee", "the", "and", "family",
    "est", "estate", "of", "ptshp", "partnership", "living", "revocable",
)
GENERIC_WORDS = (
    "land", "lands", "property", "properties", "holdings", "development", "investments", "investment", "partners", "group", "texas",
    "association", "owners", "commercial", "real", "ranch", "cattle", "capital", "ventures", "enterprises", "management", "company",
)
#: Street words and what they are read as, and words that don't tell streets apart.
STREET = {"county": "cr", "co": "cr", "road": "rd", "street": "st", "highway": "hwy", "farm": "fm", "drive": "dr", "lane": "ln"}
STREET_SKIP = ("rd", "st", "dr", "ln", "ave", "blvd", "n", "s", "e", "w", "tx", "us")
#: How names begin that a source publishes where it has none.
NO_NAME = r"^(UNKNOWN|NOT AVAIL)"
#: Owners of a subdivision's common areas.
COMMON_AREA = r"(?i)\b(HOME ?OWNERS?|PROPERTY OWNERS|OWNERS ASS(OC|N)|HOA|COMMUNITY ASS(OC|N)|MASTER ASS(OC|N))"
#: The first month of a quarter's middle and of a season.
QUARTER_MONTHS = {"1": 2, "2": 5, "3": 8, "4": 11}
SEASON_MONTHS = {"spring": 4, "summer": 7, "fall": 10, "autumn": 10, "winter": 1}


def either(text: Column, mapping: dict[str, int]) -> Column:
    """The value of a map literal by key."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), text)


def normalised(text: Column) -> Column:
    """Lower case, plain quotes and dashes, single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, FOLD_FROM, FOLD_TO)), r"\s+", " "))


def quotes(text: Column, quote: Column) -> Column:
    """Whether a non-empty quote stands in a text, both normalised."""
    return (normalised(quote) != "") & F.contains(normalised(text), normalised(quote))


def endpoint(url: Column) -> Column:
    """Host with port and path in lower case, without a slash at the end: what makes a cached answer reusable."""
    host, path = F.try_parse_url(url, F.lit("AUTHORITY")), F.try_parse_url(url, F.lit("PATH"))
    return F.regexp_replace(F.lower(F.concat(F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")))), r"/+$", "")


def coordinate_key(lat: Column, lng: Column, suffix: str = "") -> Column:
    """A cache key to five decimals."""
    return F.format_string(f"%.5f_%.5f{suffix}", lat, lng)


def alphanumeric(text: Column) -> Column:
    """Upper-case letters and digits only, as parcel numbers are compared."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def letters(name: Column) -> Column:
    """Letters only, without the word county or parish."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"\b(county|parish)\b", ""), "[^a-z]", "")


def split_tag(text: Column) -> tuple[Column, Column]:
    """(text, tag) of "text [tag]"; no tag gives null."""
    tag = F.regexp_extract(text, r"\[([^\[\]]*)\]\s*$", 1)
    return F.trim(F.regexp_replace(text, r"\s*\[[^\[\]]*\]\s*$", "")), F.nullif(F.lower(F.trim(tag)), F.lit(""))


def tag_level(tag: Column, levels: list[tuple[str, str]]) -> Column:
    """The level of the first pattern that a tag matches; no tag gives null, one that matches none ends the run."""
    out = F.when(tag.isNotNull(), F.raise_error(F.concat(F.lit("unknown tag: "), tag))).cast("string")
    for pattern, level in reversed(levels):
        out = F.when(tag.rlike(pattern), level).otherwise(out)
    return out


def owner_tokens(owner: Column) -> Column:
    """Words that tell owners apart; generic ones count only if there are no others."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(owner), F.lit(r"[a-z0-9]{2,}"), F.lit(0)))
    words = F.array_except(words, F.array(*map(F.lit, STOP_WORDS)))
    telling = F.array_except(words, F.array(*map(F.lit, GENERIC_WORDS)))
    return F.when(F.size(telling) > 0, telling).otherwise(words)


def same_owner(a: Column, b: Column) -> Column:
    """Whether one token set holds the other, or two tokens are shared."""
    shared = F.size(F.array_intersect(a, b))
    return (F.least(F.size(a), F.size(b)) > 0) & ((shared == F.least(F.size(a), F.size(b))) | (shared >= 2))


def address_parts(address: Column) -> Column:
    """struct(number, words) of the street part before the first comma, street words folded; null without a house number."""
    street = F.upper(F.split(address, ",", 2)[0])
    words = F.regexp_extract_all(F.lower(F.regexp_extract(street, r"^\s*\d+\s+(.+)", 1)), F.lit(r"[a-z0-9]+"), F.lit(0))
    short = F.create_map(*[F.lit(x) for kv in STREET.items() for x in kv])
    folded = F.array_distinct(F.transform(words, lambda w: F.coalesce(F.element_at(short, w), w)))
    told = F.array_except(folded, F.array(*map(F.lit, STREET_SKIP)))
    return F.when(street.rlike(r"^\s*\d+\s+."), F.struct(F.regexp_extract(street, r"^\s*(\d+)", 1).alias("number"), told.alias("words")))


def same_address(a: Column, b: Column) -> Column:
    """Same house number and a shared telling word of the street."""
    return F.coalesce((a["number"] == b["number"]) & (F.size(F.array_intersect(a["words"], b["words"])) > 0), F.lit(False))


def known_name(name: Column) -> Column:
    """A trimmed name, null where the source has none."""
    trimmed = F.trim(name)
    return F.when((trimmed != "") & ~F.upper(trimmed).rlike(NO_NAME), trimmed)


def circuit_name(one: Column, other: Column) -> Column:
    """A line's name from the substations at its ends, those without a name left out."""
    return F.concat_ws(" - ", known_name(one), known_name(other))


def substation_label(name: Column) -> Column:
    """A substation's name, or what stands for one in brackets."""
    trimmed = F.trim(F.coalesce(name, F.lit("")))
    return F.coalesce(known_name(name), F.when(trimmed == "", "[unnamed]").otherwise(F.concat(F.lit("[unnamed "), trimmed, F.lit("]"))))


def typed(text: Column) -> Column:
    """struct(kind, number) of a CSV value: none, bool (1 or 0), int, float or text; a number with a point is a float."""
    number = F.when(text.rlike(r"^\s*[+-]?(\d[\d_]*\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), text.try_cast("double"))
    whole = (number == F.floor(number)) & ~F.contains(text, F.lit("."))
    kind = F.when(F.coalesce(text, F.lit("")) == "", "none").when(text.isin("True", "False"), "bool").when(number.isNull(), "text").when(whole, "int").otherwise("float")
    return F.struct(kind.alias("kind"), F.when(kind == "bool", (text == "True").cast("double")).otherwise(number).alias("number"))


def property_by_name(properties: Column, name: Column | str) -> Column:
    """The first property of a map whose name is the one asked for, in any case."""
    wanted = F.lower(F.lit(name) if isinstance(name, str) else name)
    return F.get(F.filter(F.map_entries(properties), lambda e: F.lower(e["key"]) == wanted), F.lit(0))["value"]


def property_by_suffix(properties: Column, suffix: str) -> Column:
    """The first property of a map whose name ends so, in any case."""
    return F.get(F.filter(F.map_entries(properties), lambda e: F.upper(e["key"]).endswith(suffix.upper())), F.lit(0))["value"]


def preferred_acres(properties: Column) -> Column:
    """struct(acres, name): of positive numbers in acre-like properties a deeded one, then a computed one, then any; ties by name."""
    rank = lambda k: F.when(k.rlike("(?i)deed"), 0).when(k.rlike("(?i)calc|gis|total"), 1).otherwise(2)
    rows = F.transform(F.map_entries(properties), lambda e: F.struct(rank(e["key"]).alias("rank"), e["key"].alias("name"), F.trim(e["value"]).try_cast("double").alias("acres")))
    best = F.array_min(F.filter(rows, lambda r: r["name"].rlike("(?i)acre|acres|_ac$|^ac$") & (r["acres"] > 0)))
    return F.struct(best["acres"].alias("acres"), best["name"].alias("name"))


def number_text(x: Column, suffix: str = "") -> Column:
    """A number for reading: thousands by commas, one decimal only under 100 and if it has a fraction; none is a dash."""
    short = F.when((F.abs(x) >= 100) | (x == F.floor(x)), F.format_number(F.bround(x), 0)).otherwise(F.format_number(x, 1))
    return F.coalesce(F.concat(short, F.lit(suffix)), F.lit("—"))


def title_case(text: Column) -> Column:
    """Letters after no letter in upper case, all others in lower case, so also those after a hyphen, an apostrophe or a digit."""
    letters = F.regexp_extract_all(text, F.lit(r"(?s)."), F.lit(0))
    after = lambda i: F.coalesce(F.get(letters, i - 1).rlike(r"^[\p{Lu}\p{Ll}\p{Lt}]$"), F.lit(False))
    return F.array_join(F.transform(letters, lambda c, i: F.when(after(i), F.lower(c)).otherwise(F.upper(c))), "")


def market_of(section: Column) -> Column:
    """The market a section's heading names, in title case."""
    name = F.split(F.split(section, r" \(", 2)[0], " · ", 2)[0]
    return F.regexp_replace(title_case(name), "Msa", "MSA")


def nearest_text(metres: Column, status: Column, about: Column) -> Column:
    """A distance in words, or within what none was found, as method or note say it."""
    radius = F.nullif(F.regexp_extract(about, r"within (\d+) m", 1), F.lit("")).cast("double") / 1000
    none = F.concat(F.lit("none within "), F.regexp_replace(radius.cast("string"), r"\.0$", ""), F.lit(" km"))
    return F.when(metres.isNotNull(), F.concat(F.format_number(metres, 0), F.lit(" m"))).when((status == "absent") & radius.isNotNull(), none).otherwise("—")


def first_power(text: Column) -> Column:
    """"now" or the year of an availability text."""
    return F.when(text.rlike(r"(?i)immediate|now\b"), "now").otherwise(F.nullif(F.regexp_extract(text, r"\b(20\d\d)\b", 1), F.lit("")))


def power_span(firsts: Column) -> Column:
    """The aggregate span of first_power values: "now" before years; one value alone, none a dash."""
    now, least, most = F.bool_or(firsts == "now"), F.min(F.when(firsts != "now", firsts)), F.max(F.when(firsts != "now", firsts))
    low, high = F.when(now, "now").otherwise(least), F.coalesce(most, F.lit("now"))
    return F.when(F.count(firsts) == 0, "—").when(low == high, low).otherwise(F.concat(low, F.lit("–"), high))


def tract_acres(words: Column) -> Column:
    """The acreage that stands in words."""
    return F.nullif(F.regexp_extract(words, r"(?i)(\d+(?:\.\d+)?)\s*(?:ac|acres?)\b", 1), F.lit("")).cast("double")


def fiber_text(status: Column, carrier: Column, nrc: Column, route1: Column, route2: Column) -> Column:
    """What is said of fibre: a quote with carrier, cost and both routes, else the status in words."""
    quoted = F.when(nrc.isNotNull(), F.concat(F.coalesce(carrier, F.lit("")), F.lit(" build $"), F.format_number(nrc / 1e6, 2), F.lit("M"))).otherwise("quoted")
    routes = F.when(route1.isNotNull() & route2.isNotNull(), F.concat(F.lit("; routes "), number_text(route1), F.lit(" / "), number_text(route2), F.lit(" ft"))).otherwise("")
    return F.when(status.isNull(), "").when(status != "quoted", F.translate(status, "_", " ")).otherwise(F.concat(quoted, routes))


def substation_claim(words: Column) -> Column:
    """struct(claim, miles) of what is said of a substation: adjacent, at a distance, or neither."""
    miles = F.nullif(F.regexp_extract(words, r"~?\s*(\d+(?:\.\d+)?)\s*mi\b", 1), F.lit("")).cast("double")
    claim = F.when(F.contains(F.lower(words), F.lit("adjacent")), "adjacent").when(miles.isNotNull(), "distance")
    return F.struct(claim.alias("claim"), miles.alias("miles"))


def name_tokens(name: Column) -> Column:
    """The words of a substation's name that can tell it apart: over two letters and none of the usual ones."""
    words = F.regexp_extract_all(F.lower(name), F.lit("[a-z]+"), F.lit(0))
    return F.filter(F.array_except(words, F.array(*map(F.lit, ("road", "sub", "substation", "new")))), lambda w: F.length(w) > 2)


def split_address(text: Column) -> Column:
    """struct(street, city, state, zip) of "street, city, ST zip"."""
    parts = F.transform(F.split(text, ","), F.trim)
    last = F.element_at(parts, -1)
    state, code = F.regexp_extract(last, r"^([A-Za-z]{2})\b", 1), F.regexp_extract(last, r"(\d{5})(?:-\d{4})?$", 1)
    return F.struct(F.get(parts, F.lit(0)).alias("street"), F.get(parts, F.size(parts) - 2).alias("city"), F.upper(state).alias("state"), code.alias("zip"))


def months_until(text: Column, year: Column, month: Column) -> Column:
    """Months from a year and month to a timing in words; null if it names none, never under 0.

    In this order: now, a quarter, a season, the end of a year, the later year
    of a span, a year's June.
    """
    t = F.lower(text)
    pick = lambda pattern, i: F.regexp_extract(t, pattern, i)
    quarter, season = r"\bq([1-4])\s*(20\d\d)", r"\b(spring|summer|fall|autumn|winter)\b[^0-9]*(20\d\d)"
    ending, span, plain = r"\bend-(20\d\d)", r"20\d\d\s*[-–]\s*(\d\d)\b", r"(20\d\d)"
    whole = lambda y, m: y.try_cast("int") * 12 + m - (year * 12 + month)
    out = (
        F.when(t.rlike(r"\bimmediate|\bnow\b"), 0)
        .when(t.rlike(quarter), whole(pick(quarter, 2), either(pick(quarter, 1), QUARTER_MONTHS)))
        .when(t.rlike(season), whole(pick(season, 2), either(pick(season, 1), SEASON_MONTHS)))
        .when(t.rlike(ending), whole(pick(ending, 1), F.lit(12)))
        .when(t.rlike(span), whole(F.concat(F.lit("20"), pick(span, 1)), F.lit(6)))
        .when(t.rlike(plain), whole(pick(plain, 1), F.lit(6)))
    )
    return F.when(out.isNotNull(), F.greatest(F.lit(0), out))


def zone_list(text: Column) -> Column:
    """array of struct(label, acres, pct) from "AE 1.5 ac (20%); X 6 ac (80%)"."""
    pattern = r"^\s*(.*?)\s+([0-9.]+)\s*ac\s*\(([0-9.]+)\s*%\)\s*$"
    part = lambda s, i: F.regexp_extract(s, pattern, i)
    return F.transform(
        F.filter(F.split(text, ";"), lambda s: s.rlike(pattern)),
        lambda s: F.struct(part(s, 1).alias("label"), part(s, 2).cast("double").alias("acres"), part(s, 3).cast("double").alias("pct")),
    )


def without_contained(statements: Column) -> Column:
    """Statements whose words no other one holds; of equal ones the first."""
    words = F.transform(statements, lambda s: F.array_distinct(F.regexp_extract_all(F.lower(s), F.lit("[a-z0-9]+"), F.lit(0))))
    held = lambda i: F.exists(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda j: (j != i)
        & (F.size(F.array_except(F.get(words, i), F.get(words, j))) == 0)
        & ((F.size(F.get(words, i)) < F.size(F.get(words, j))) | (j < i)),
    )
    return F.filter(statements, lambda s, i: ~held(i))


def location_words(cells: Column) -> Column:
    """Labels and texts that tell where a site is, by rank and then order, without texts that an earlier one holds.

    cells: array of struct(rank, ordinal, label, text), ranks for instance name,
    location, acreage, cited; texts are compared by their words in lower case.
    """
    plain = lambda c: F.trim(F.regexp_replace(F.lower(c["text"]), r"[^\p{L}\p{N}_]+", " "))
    keyed = F.transform(F.array_sort(cells), lambda c: F.struct(c["label"].alias("label"), c["text"].alias("text"), plain(c).alias("plain")))
    nothing = F.struct(F.lit("").alias("said"), F.array().cast("array<struct<label:string,text:string>>").alias("kept"))

    def told(got: Column, c: Column) -> Column:
        """What is said, the words of the kept texts, a line each, is searched once for a cell: what a dropped text holds, the one that holds it holds too."""
        said, kept, first = got["said"], got["kept"], F.size(got["kept"]) == 0
        # After a missing text nothing is kept: what it holds isn't known.
        known = said.isNotNull() & c["plain"].isNotNull()
        more = F.when(first | known, F.concat(kept, F.array(F.struct(c["label"].alias("label"), c["text"].alias("text"))))).otherwise(kept)
        return F.when(~first & F.contains(said, c["plain"]), got).otherwise(F.struct(F.concat(said, F.lit("\n"), c["plain"]).alias("said"), more.alias("kept")))

    return F.aggregate(keyed, nothing, told, lambda got: got["kept"])


def narrative_sections(text: Column) -> Column:
    """array of struct(section, body) of a Markdown text by its "## " headings; what stands before them is the Summary.

    Other heading lines are left out, sections of one name are joined, empty ones dropped.
    """
    parts = F.split(F.concat(F.lit("## Summary\n"), text), r"(?m)^##[ \t]+(?=\S)")
    cut = lambda s: F.trim(F.regexp_replace(s, r"^\s+|\s+$", ""))
    body = lambda s: F.regexp_replace(F.when(F.contains(s, F.lit("\n")), F.regexp_replace(s, r"^[^\n]*\n", "")).otherwise(""), r"(?m)^#.*$\n?", "")
    found = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda s: F.struct(cut(F.substring_index(s, "\n", 1)).alias("section"), body(s).alias("body")))
    names = F.array_distinct(F.transform(found, lambda f: f["section"]))
    joined = F.transform(names, lambda n: F.struct(n.alias("section"), cut(F.array_join(F.transform(F.filter(found, lambda f: f["section"] == n), lambda f: cut(f["body"])), "\n")).alias("body")))
    return F.filter(joined, lambda f: f["body"] != "")


def profile_block(text: Column, defaults: dict[str, str | None], required: tuple[str, ...]) -> Column:
    """struct(values, error) of the first fenced JSON block: its values over the defaults, or why there are none."""
    block = F.nullif(F.regexp_extract(text, r"(?s)```json\s*\n(.*?)\n```", 1), F.lit(""))
    given = F.from_json(block, "map<string,string>")
    known = F.array(*map(F.lit, sorted(defaults)))
    unknown = F.array_sort(F.array_except(F.map_keys(given), known))
    missing = F.filter(F.array(*map(F.lit, required)), lambda k: F.coalesce(given[k], F.lit("")) == "")
    error = (
        F.when(block.isNull(), "no json block")
        .when(given.isNull(), "the json block is not valid")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown keys: "), F.array_join(unknown, ", ")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    )
    base = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]).cast("map<string,string>")
    values = F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(given), k)), given)
    return F.struct(F.when(error.isNull(), values).alias("values"), error.alias("error"))

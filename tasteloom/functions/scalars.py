"""Row-level cleaning and presentation rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: rating given to each behaviour, and to any other behaviour
EVENT_RATINGS = {"view": 3.0, "like": 5.0, "cart": 5.0, "wishlist": 4.0, "purchase": 5.0}
OTHER_EVENT_RATING = 3.0

# fixed values: keyword rules over category and title, first match wins
CATEGORY_KEYWORDS: tuple[tuple[tuple[str, ...], str], ...] = (
    (("headphone", "earbud", "earphone"), "🎧"),
    (("camera", "webcam"), "📷"),
    (("laptop", "notebook", "macbook", "chromebook"), "💻"),
    (("watch",), "⌚"),
    (("bulb", "light"), "💡"),
    (("keyboard",), "⌨️"),
    (("speaker", "soundbar", "audio"), "🔊"),
    (("phone", "mobile", "iphone"), "📱"),
    (("cable", "charger", "adapter", "power"), "🔌"),
    (("tv", "monitor", "display", "screen"), "📺"),
    (("mouse",), "🖱️"),
    (("tablet", "ipad"), "📱"),
    (("drive", "storage", "ssd", "usb"), "💾"),
    (("router", "network", "wifi"), "📡"),
    (("battery",), "🔋"),
    (("case", "cover", "bag"), "🎒"),
    (("cable", "cord", "wire"), "🔌"),
)
OTHER_CATEGORY_ICON = "📦"

_LIST_IMAGES = "array<struct<thumb:string,large:string,hi_res:string>>"
_DICT_IMAGES = "struct<thumb:array<string>,large:array<string>,hi_res:array<string>>"
_IMAGE_SIZES = ("large", "hi_res", "thumb")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(_c(col), F.lit(""))


def nan_to_null(col: Column | str) -> Column:
    return F.when(~F.isnan(_c(col)), _c(col))


def clean_price(col: Column | str) -> Column:
    """Mean of all numbers in a raw price ("$10 - $20" is 15), null without any.
    A plain number, also with sign or exponent, is taken as it is."""
    plain = F.when(F.trim(_c(col)).rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), F.trim(_c(col)).try_cast("double"))
    found = F.regexp_extract_all(_c(col), F.lit(r"([\d,]+\.?\d*)"), F.lit(1))
    digits = F.transform(found, lambda s: F.replace(s, F.lit(","), F.lit("")))
    values = F.transform(
        F.filter(digits, lambda s: F.replace(s, F.lit("."), F.lit("")) != ""),
        lambda s: s.try_cast("double"),
    )
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.coalesce(plain, F.when(F.size(values) > 0, total / F.size(values)))


def pick_image(col: Column | str) -> Column:
    """First non-empty image of a raw JSON value: list of entries, or lists per size."""
    entries = F.from_json(_c(col), _LIST_IMAGES)
    per_entry = F.transform(
        entries, lambda e: F.coalesce(*(F.nullif(e[s], F.lit("")) for s in _IMAGE_SIZES))
    )
    from_list = F.try_element_at(F.filter(per_entry, lambda u: u.isNotNull()), F.lit(1))
    lists = F.from_json(_c(col), _DICT_IMAGES)
    from_dict = F.coalesce(
        *(
            F.try_element_at(F.filter(lists[s], lambda u: u.isNotNull() & (u != "")), F.lit(1))
            for s in _IMAGE_SIZES
        )
    )
    is_list = F.startswith(F.ltrim(_c(col)), F.lit("["))
    return F.when(is_list, from_list).otherwise(from_dict)


def leaf_category(categories: Column | str, main: Column | str) -> Column:
    """Most specific category; the main category when the path is empty."""
    path = _c(categories)
    return F.when(F.size(path) > 0, F.try_element_at(path, F.lit(-1))).otherwise(_c(main))


def epoch_ms(year: int) -> int:
    from datetime import datetime, timezone

    return int(datetime(year, 1, 1, tzinfo=timezone.utc).timestamp() * 1000)


def is_recent(ts: Column | str, from_year: int) -> Column:
    return _c(ts) >= F.lit(epoch_ms(from_year))


def is_positive(rating: Column | str, threshold: float = 4.0) -> Column:
    return _c(rating) >= F.lit(threshold)


def ms_to_timestamp(ts: Column | str) -> Column:
    return F.timestamp_millis(_c(ts))


def event_rating(event_type: Column | str) -> Column:
    pairs = [F.lit(x) for kv in EVENT_RATINGS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(event_type)), F.lit(OTHER_EVENT_RATING))


def line_total(price: Column | str, qty: Column | str) -> Column:
    return F.coalesce(_c(price), F.lit(0.0)) * F.coalesce(_c(qty), F.lit(1))


def top_rated(avg_rating: Column | str, threshold: float = 4.7) -> Column:
    return F.coalesce(_c(avg_rating) >= F.lit(threshold), F.lit(False))


def category_icon(category: Column | str, title: Column | str, rules=CATEGORY_KEYWORDS,
                  other: str = OTHER_CATEGORY_ICON) -> Column:
    text = F.lower(F.concat_ws(" ", F.coalesce(_c(category), F.lit("")), F.coalesce(_c(title), F.lit(""))))
    chain = None
    for words, icon in rules:
        hit = F.greatest(*(F.contains(text, F.lit(w)) for w in words), F.lit(False))
        chain = F.when(hit, icon) if chain is None else chain.when(hit, icon)
    return chain.otherwise(other)


def variety_to_lambda(variety: Column | str) -> Column:
    return F.round(F.lit(1.0) - (_c(variety) - F.lit(1.0)) * F.lit(0.25), 3)


def reason_text(title: Column | str, width: int = 45) -> Column:
    return F.concat(F.lit("Because you viewed "), F.substring(_c(title), 1, width))


def model_label(base: Column | str, mmr_lambda: float = 1.0) -> Column:
    """Label of the stage that produced a list, with the diversity setting if used."""
    column = F.lit(base) if isinstance(base, str) else base
    if mmr_lambda >= 0.999:
        return column
    return F.concat(column, F.lit(f" + MMR(λ={mmr_lambda:g})"))

"""What goes out: filters, presentation columns and the workbook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import text
from adlens.sources.sinks import write_sheets

# Columns of the export, their titles and widths.
COLUMNS = (
    ("crop", "Фото щита", 58), ("address", "Адрес щита", 30), ("construction", "Тип конструкции", 18), ("developer", "Застройщик", 20),
    ("complex_name", "ЖК", 22), ("offer_type", "Тип предложения", 18), ("advertiser_type", "Тип рекламодателя", 18), ("phones", "Телефон СО ЩИТА", 18),
    ("dir_phone", "Телефон из справочника", 20), ("sites", "Сайт СО ЩИТА", 18), ("dir_site", "Сайт из справочника", 20),
    ("phones_unreliable", "Ненадёжные контакты", 18), ("shot_date", "Дата съёмки", 13), ("lat", "Широта", 11), ("lon", "Долгота", 11),
    ("source_url", "Панорама", 12), ("text", "Текст со щита", 30), ("banner_id", "ID", 14),
)


def is_realty(include_unsure: bool = True, strict_case: bool = False) -> Column:
    """Row of the segment; with `strict_case` only the lower-case spelling counts."""
    flag = F.coalesce("is_realty", F.lit(""))
    return (flag if strict_case else F.lower(flag)).isin(["да", "не уверен"] if include_unsure else ["да"])


def realty(banners: DataFrame, include_unsure: bool = True, personal: bool | None = None, strict_case: bool = False) -> DataFrame:
    """Rows of the segment. Null personal flags are false."""
    out = banners.filter(is_realty(include_unsure, strict_case))
    return out if personal is None else out.filter(F.coalesce("personal_ad", F.lit(False)) == personal)


def category_counts(banners: DataFrame) -> DataFrame:
    """(category, n), most frequent first."""
    return banners.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def by_category(banners: DataFrame, every: bool = False, category: str | None = None, configured: str | None = None) -> DataFrame:
    """All rows, else those of the asked, else of the configured category."""
    wanted = None if every else category or configured
    return banners if wanted is None else banners.filter(F.col("category") == wanted)


def presentation(banners: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The export's columns in order, null-free but for the position."""
    c = F.col
    shown = {
        "crop": text.or_empty(c("crop_image_path")),
        "developer": text.shown_developer(c("developer"), c("advertiser"), c("brand_matched")),
        "phones": text.or_empty(text.joined(c("phones"))),
        "sites": text.or_empty(text.joined(c("sites"))),
        "phones_unreliable": text.or_empty(text.joined(c("phones_unreliable"))),
        "shot_date": text.shot_date(c("timestamp")),
        "lat": c("lat"),
        "lon": c("lon"),
    }
    return banners.select(*(extra or ()), *[shown.get(k, text.or_empty(c(k)) if k in banners.columns else F.lit("")).alias(k) for k, _, _ in COLUMNS])


def export_workbook(banners: DataFrame, path: str, realty_only: bool = False, include_unsure: bool = True, pictures: DataFrame | None = None) -> int:
    """Writes the workbook; rows of private advertisements go on a sheet of their own and aren't counted.

    `pictures` (crop_image_path, data: PNG) are shown over the first cell of their rows.
    """
    if pictures is not None:
        one = pictures.filter("crop_image_path is not null").groupBy("crop_image_path").agg(F.min("data").alias("_picture"))
        banners = banners.join(one, "crop_image_path", "left")
    order = [F.coalesce("developer", "advertiser", F.lit("яяя")).asc(), F.col("complex_name").asc_nulls_first()]
    if realty_only:
        parts = [("недвижимость", realty(banners, include_unsure, False)), ("частные объявления", realty(banners, include_unsure, True))]
    else:
        parts = [("banners", banners)]
        order = [F.col("category").asc_nulls_first()]
    titles = {k: t for k, t, _ in COLUMNS}
    extra = [] if pictures is None else ["_picture"]
    sheets = [(title, presentation(df.orderBy(*order), extra).toDF(*extra, *[titles[k] for k, _, _ in COLUMNS])) for title, df in parts]
    counts = write_sheets(path, sheets, {t: w for _, t, w in COLUMNS}, link=titles["source_url"], picture="_picture")
    return counts[0]

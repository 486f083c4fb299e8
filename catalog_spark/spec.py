"""Column catalog of the product table and the immutable feature specification."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

# Columns of the flattened product table, in output order where order matters.
NUMERIC_COLUMNS = (
    "data-product-price-current_retail_min",
    "data-product-price-reg_retail_max",
    "data-product-ratings_and_reviews-statistics-rating-average",
    "data-product-ratings_and_reviews-statistics-rating-count",
    "data-product-ratings_and_reviews-statistics-review_count",
    "data-product-ratings_and_reviews-statistics-recommended_percentage",
    "data-product-item-package_dimensions-weight",
    "data-product-item-package_dimensions-depth",
    "data-product-item-package_dimensions-height",
    "data-product-item-package_dimensions-width",
)
CATEGORICAL_COLUMNS = (
    "data-product-category-name",
    "data-product-item-primary_brand-name",
    "data-product-item-product_classification-item_type-name",
    "data-product-item-product_classification-purchase_behavior",
    "data-product-item-merchandise_classification-department_name",
    "data-product-item-handling-import_designation_description",
    "data-product-item-relationship_type_code",
    "data-product-item-return_method",
)
TEXT_COLUMNS = (
    "data-product-item-product_description-title",
    "data-product-item-product_description-bullet_descriptions",
    "data-product-item-product_description-soft_bullet_description",
    "data-product-item-product_description-downstream_description",
    "data-product-category-breadcrumbs",
)
ORIGIN_COLUMNS = (
    "data-product-item-handling-import_designation_description",
    "handling-import_designation_description",
    "children_handling_mode",
)
ITEM_ID_COLUMNS = ("data-product-tcin", "_tcin", "data-product-item-primary_barcode", "data-product-item-dpci")
CATEGORY_NAME = "data-product-category-name"
CATEGORY_PATH = "category_path"
BREADCRUMBS = "data-product-category-breadcrumbs"
SECONDARY_AVERAGES = "data-product-ratings_and_reviews-statistics-secondary_averages"
CHILDREN = "data-product-children"
NODE_IDS = "data-product-sales_classification_nodes-node_ids"
MIN_PRICE_CHAIN = (
    "data-product-price-current_retail_min",
    "data-product-price-current_retail",
    "children_price_min",
)
MAX_PRICE_CHAIN = (
    "data-product-price-reg_retail_max",
    "data-product-price-reg_retail",
    "children_price_max",
)
WEIGHT = "data-product-item-package_dimensions-weight"
DIMENSIONS = (
    "data-product-item-package_dimensions-depth",
    "data-product-item-package_dimensions-height",
    "data-product-item-package_dimensions-width",
)
VOLUME = "pkg_volume_lwh"
RATING_EXTRAS = ("rating_quality", "rating_value")
OUTPUT_COLUMNS_BEFORE_NEIGHBORS = (
    "_store_id",
    "_tcin",
    "data-product-tcin",
    "data-product-item-primary_barcode",
    "data-product-item-dpci",
    "data-product-item-enrichment-buy_url",
    "data-product-item-enrichment-image_info-primary_image-url",
    "data-product-category-name",
    "category_path",
    "cluster_label",
    "data-product-item-primary_brand-name",
    "data-product-item-product_classification-item_type-name",
    "data-product-price-current_retail_min",
    "data-product-price-reg_retail_max",
    "price_band",
    "children_price_min",
    "children_price_max",
    "pkg_volume_lwh",
    "data-product-item-package_dimensions-weight",
    "data-product-item-package_dimensions-depth",
    "data-product-item-package_dimensions-height",
    "data-product-item-package_dimensions-width",
    "data-product-ratings_and_reviews-statistics-rating-average",
    "data-product-ratings_and_reviews-statistics-rating-count",
    "data-product-ratings_and_reviews-statistics-review_count",
    "data-product-item-handling-import_designation_description",
    "children_handling_mode",
    "tariff_risk",
    "cluster_dist",
    "cluster_outlier",
)
PROJECTION_COLUMNS = ("proj_x", "proj_y")


def missing(name: str) -> str:
    return f"{name}__missing"


def parsed(name: str) -> str:
    return f"{name}__parsed"


def present(df: DataFrame, names) -> list[str]:
    """The given names that ``df`` has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def select_present(df: DataFrame, names) -> DataFrame:
    """Projection that leaves out absent columns."""
    return df.select(*present(df, names))


def output_columns(neighbors: int = 3) -> list[str]:
    """Column order of the enriched output for any number of neighbours."""
    pairs = [f"nn{i}_{part}" for i in range(1, neighbors + 1) for part in ("id", "dist")]
    return ["cluster_id", *OUTPUT_COLUMNS_BEFORE_NEIGHBORS, *pairs, *PROJECTION_COLUMNS, NODE_IDS]


def curated(df: DataFrame, neighbors: int = 3, names=None) -> DataFrame:
    """Enriched output: the cluster first, then the known columns that exist."""
    return select_present(df, names or output_columns(neighbors))


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns feed the clusters, and the weight of each block."""

    numeric: tuple[str, ...] = NUMERIC_COLUMNS
    categorical: tuple[str, ...] = CATEGORICAL_COLUMNS
    text: tuple[str, ...] = TEXT_COLUMNS
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    dimensions: tuple[str, ...] = field(default=DIMENSIONS)

    @classmethod
    def from_options(cls, numeric: str | None = None, categorical: str | None = None, text: str | None = None, weights=None):
        """Defaults, each replaced by a pipe-separated list if given."""
        spec = cls()
        if numeric:
            spec = replace(spec, numeric=tuple(numeric.split("|")))
        if categorical:
            spec = replace(spec, categorical=tuple(categorical.split("|")))
        if text:
            spec = replace(spec, text=tuple(text.split("|")))
        return replace(spec, weights=tuple(weights)) if weights else spec

    def resolve(self, df: DataFrame) -> "FeatureSpec":
        """Keep what exists, add ratings, and let volume and missing flags stand for the dimensions."""
        have = set(df.columns)
        wanted = [c for c in self.numeric if c not in self.dimensions]
        extras = [*RATING_EXTRAS]
        if VOLUME in have:
            extras += [VOLUME, missing(VOLUME)]
        extras += [missing(c) for c in (WEIGHT, MIN_PRICE_CHAIN[0], MAX_PRICE_CHAIN[0])]
        numeric = dict.fromkeys([c for c in [*wanted, *extras] if c in have])
        text = [c for c in self.text if c in have]
        text += [parsed(c) for c in self.text if parsed(c) in have]
        if CATEGORY_PATH in have:
            text.append(CATEGORY_PATH)
        return replace(
            self,
            numeric=tuple(numeric),
            categorical=tuple(c for c in self.categorical if c in have),
            text=tuple(dict.fromkeys(text)),
        )


def item_id(df: DataFrame, candidates=ITEM_ID_COLUMNS, fallback_keys: list[str] | None = None) -> Column:
    """First existing id column as text, else a hash of the given key columns."""
    for name in candidates:
        if name in df.columns:
            return F.col(name).cast("string")
    keys = fallback_keys or [c for c, t in df.dtypes if t != "variant" and "map<" not in t]
    return F.xxhash64(*keys).cast("string")

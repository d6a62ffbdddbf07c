"""Column expressions: all built-in Spark functions, no UDFs."""

from .categories import category_of, is_category, transform_category
from .features import active_segment, most_watch, taste

__all__ = ["category_of", "is_category", "transform_category", "most_watch", "taste", "active_segment"]

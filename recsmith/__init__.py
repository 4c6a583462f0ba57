"""recsmith: rating and recommendation pipelines as Spark DataFrame jobs.

The main entry points, by stage (see README for the full map):

- ingest: ``extract_items``, ``extract_profile``, ``new_ratings``, ``new_items``,
  ``assign_item_ids``, ``ingest_crawl``, ``discover_seeds``, ``stream_ingest_pages``
- ratings: ``export_ratings``, ``active_users``, ``to_als_ratings``, ``split_ratings``
- model: ``als_fit``, ``als_user_recs``, ``similar_items``, ``refresh_rec_lists``
- evaluation: ``precision_recall_curve``, ``mse``, ``evaluate_als``, ``rank_grid``
- serving: ``serve_user``, ``serve_similar``, ``rec_titles``
"""

__version__ = "0.1.0"

from .operators.evaluate import mse, precision_recall_curve  # noqa: E402
from .operators.ingest import assign_item_ids, new_items, new_ratings  # noqa: E402
from .operators.model import als_fit, als_user_recs, evaluate_als, rank_grid  # noqa: E402
from .operators.pages import extract_items, extract_profile  # noqa: E402
from .operators.ratings import active_users, export_ratings, split_ratings, to_als_ratings  # noqa: E402
from .operators.serve import rec_titles, serve_similar, serve_user  # noqa: E402
from .operators.similarity import similar_items  # noqa: E402
from .plans.crawl import discover_seeds, ingest_crawl  # noqa: E402
from .plans.refresh import refresh_rec_lists  # noqa: E402
from .streaming.ingest import stream_ingest_pages  # noqa: E402

__all__ = [
    "active_users", "als_fit", "als_user_recs", "assign_item_ids", "discover_seeds", "evaluate_als",
    "export_ratings", "extract_items", "extract_profile", "ingest_crawl", "mse", "new_items", "new_ratings",
    "precision_recall_curve", "rank_grid", "rec_titles", "refresh_rec_lists", "serve_similar",
    "serve_user", "similar_items", "split_ratings", "stream_ingest_pages", "to_als_ratings",
]

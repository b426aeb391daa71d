"""Query plans: end-to-end pipelines and the registered query set."""


def load_all() -> None:
    """Import every query module so its queries register themselves."""
    from ratesmith.plans import (  # noqa: F401
        q_analysis, q_boosting, q_features, q_io, q_models, q_neighbors)

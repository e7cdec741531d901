from creditloom.plans.registry import ORACLES, QUERIES, query

# importing a module of queries registers them
from creditloom.plans import applicant_queries, check_queries, dataset_queries, data_queries, metric_queries, model_check_queries, model_queries, monitoring_queries, panel_queries, population_queries  # noqa: E402, F401, I001

__all__ = ["ORACLES", "QUERIES", "query"]

from tradegrain.sources.json_files import hinted_schema, read_json, with_lineage  # noqa: F401
from tradegrain.sources.landing import land, landed_report  # noqa: F401
from tradegrain.sources.schemas import CUSTOMERS, ORDERS, PRODUCTS  # noqa: F401
from tradegrain.sources.tables import read_table, replace_files, replace_table  # noqa: F401

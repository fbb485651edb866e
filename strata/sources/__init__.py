from strata.sources.files import (  # noqa: F401
    PASSENGER_SCHEMA, SALES_SCHEMA, SCORING_SCHEMA, read_passengers, read_predictions,
    read_sales, read_scoring_set, write_predictions,
)
from strata.sources.tables import (  # noqa: F401
    TABLES, documents_labelled, passengers, read_table, sales,
)

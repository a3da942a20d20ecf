from lakemart.functions.columns import *  # noqa: F403

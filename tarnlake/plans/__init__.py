"""Business queries: each module pairs Spark plans with the SQL that checks them."""

"""Usage and subscription analytics as lazy Spark DataFrame builders."""

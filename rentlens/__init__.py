"""Rent-to-sale capitalisation rates from property listings, as Spark jobs."""

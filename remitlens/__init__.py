"""Claim-denial analytics on Spark: cleanse, adjudicate, price, aggregate and explain."""

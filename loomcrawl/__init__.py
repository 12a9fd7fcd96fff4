"""loomcrawl: web-crawl analytics written on the Spark DataFrame and SQL APIs."""

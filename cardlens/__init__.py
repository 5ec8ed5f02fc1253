"""cardlens: document, layout and text analytics expressed as Spark DataFrame jobs."""

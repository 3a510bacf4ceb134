"""tidemark: keep business tables in step with a CRM by Spark jobs.

Landed extracts, custom-field metadata and pushed change messages go in;
current tables, a watermark log, reports and a quarantine come out.
"""

__version__ = "0.1.0"

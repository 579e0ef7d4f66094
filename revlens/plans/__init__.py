"""End-to-end jobs: ingest, the app pages as lazy result sets, the registered queries."""

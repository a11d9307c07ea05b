"""Model graph, dashboard document and the end-to-end job."""

"""Writers of the layers, the KPI tables and the models."""

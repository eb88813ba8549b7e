"""vigil: network-threat analytics as composable Spark DataFrame operators.

Main entry points (each a ``DataFrame -> DataFrame`` function unless noted):

* ``vigil.sources.logs``       ``read_csv_logs``, ``write_logs``, ``read_logs``
* ``vigil.sources.messages``   ``parse_json_logs``, ``normalize_logs``, ``encode_messages``
* ``vigil.operators.detect``   ``detect_port_scan``, ``detect_attack_patterns``, ``detect_signatures``,
                               ``detect_brute_force``, ``detect_volume_anomaly``, ``detect_port_scan_stream``
* ``vigil.operators.analyze``  ``reputation_by_ip_logtype``, ``top_malicious_ips``, ``volume_stats``,
                               ``threat_timeline``
* ``vigil.operators.alerts``   ``all_alerts``, ``active_alerts``, ``recent_alerts_per_ip``, ``speed_summary``
* ``vigil.operators.serving``  ``reputation_snapshot``, ``attack_type_index``, ``threat_profiles``
* ``vigil.streaming.detectors`` stream sources, ``start_all``, ``read_alerts`` (streaming queries)
* ``vigil.plans.jobs``         ``run_all`` (batch job driver); ``vigil.plans.serve`` (request answers)
* ``python -m vigil``          command line
"""

__version__ = "0.1.0"

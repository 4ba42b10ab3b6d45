"""Landed documents for every service: small, hand-written, with the awkward cases in them."""

from __future__ import annotations

import json

ACCOUNT = {"account_id": "111", "account_name": "prod", "region": "us-east-1"}

DOCS: dict[str, dict[str, list[dict]]] = {
    "ec2": {
        "instances": [
            {
                "Reservations": [
                    {
                        "Instances": [
                            {
                                "InstanceId": "i-1", "InstanceType": "t3.micro", "State": {"Name": "running"},
                                "Placement": {"AvailabilityZone": "a"}, "VpcId": "vpc-1", "ImageId": "ami-1",
                                "SecurityGroups": [{"GroupName": "web"}, {"GroupName": "db"}],
                                "BlockDeviceMappings": [{"Ebs": {"VolumeId": "vol-1"}}, {}],
                                "Tags": [{"Key": "Name", "Value": "front"}, {"Key": "Name", "Value": "x"}],
                            },
                            {
                                "InstanceId": "i-2", "InstanceType": "t3.micro", "State": {"Name": "stopped"},
                                "Placement": {"AvailabilityZone": "a"}, "Platform": "windows",
                                "IamInstanceProfile": {"Arn": "arn:aws:iam::1:instance-profile/admin"},
                            },
                        ]
                    },
                    {"Instances": []},
                ]
            }
        ],
        "vpcs": [{"Vpcs": [{"VpcId": "vpc-1", "Tags": [{"Key": "Name", "Value": "main"}]}]}],
        "images": [{"Images": [{"ImageId": "ami-1", "Description": "Amazon Linux"}]}],
    },
    "lambda": {
        "functions": [{"Functions": [{"FunctionName": "f", "FunctionArn": "arn:f", "Runtime": "python3.12"}]}],
        "configurations": [{"FunctionName": "f", "Handler": "h", "Environment": {"Variables": {"A": "1"}}}],
        "policies": [{"FunctionName": "f", "Policy": json.dumps({"Statement": [{"Principal": {"Service": "s3.amazonaws.com"}}, {"Principal": "*"}]})}],
        "tags": [{"FunctionName": "f", "Tags": {"team": "core"}}],
    },
    "eks": {
        "clusters": [{"cluster": {"name": "k", "version": "1.32", "supportType": "STANDARD", "status": "ACTIVE"}}],
        "addons": [{"clusterName": "k", "addons": ["coredns", "vpc-cni"]}],
    },
    "ecr": {
        "repositories": [{"repositories": [{"repositoryName": "r", "repositoryUri": "111.dkr.x/r"}]}],
        "statistics": [{"repositoryName": "r", "repositoryStatistics": []}],
        "images": [{"repositoryName": "r", "imageIds": [{"imageTag": "v1"}, {}]}],
        "tags": [{"repositoryName": "r", "tags": [{"key": "BusinessAppID", "value": "B1"}]}],
    },
    "emr": {
        "clusters": [{"Clusters": [{"Id": "j-1", "Name": "c"}, {"Id": "j-2"}]}],
        "details": [{"Cluster": {"Id": "j-1", "Applications": [{"Name": "Spark"}], "Status": {"State": "WAITING"}}}],
    },
    "vpc": {
        "vpcs": [{"Vpcs": [{"VpcId": "vpc-1", "CidrBlock": "10.0.0.0/16", "State": "available"}]}],
        "subnets": [{"Subnets": [{"SubnetId": "sn-2", "VpcId": "vpc-1", "AvailabilityZone": "b"}, {"SubnetId": "sn-1", "VpcId": "vpc-1", "AvailabilityZone": "b"}]}],
        "security_groups": [{"SecurityGroups": [{"GroupId": "sg-1", "VpcId": "vpc-1"}]}],
        "network_acls": [{"NetworkAcls": []}],
        "internet_gateways": [{"InternetGateways": [{"InternetGatewayId": "igw-1", "Attachments": [{"VpcId": "vpc-1"}]}]}],
        "vpn_connections": [{"VpnConnections": [{"VpnConnectionId": "vpn-1"}]}],
        "vpc_endpoints": [{"VpcEndpoints": [{"VpcEndpointId": "ep-1", "VpcId": "vpc-1", "SubnetIds": ["sn-1"]}]}],
        "vpc_peerings": [{"VpcPeeringConnections": [{"VpcPeeringConnectionId": "pcx-1", "RequesterVpcInfo": {"VpcId": "vpc-9"}, "AccepterVpcInfo": {"VpcId": "vpc-1"}}]}],
        "route_tables": [{"RouteTables": [{"RouteTableId": "rt-1", "VpcId": "vpc-1", "Associations": [{"SubnetId": "sn-1"}, {}]}]}],
    },
    "subnets": {
        "network_interfaces": [{"NetworkInterfaces": [{"NetworkInterfaceId": "e", "SubnetId": "sn-1", "Groups": [{"GroupId": "sg-1"}]}]}],
    },
    "route53": {
        "zones": [{"HostedZones": [{"Id": "/hostedzone/Z1", "Name": "x.org."}]}],
        "records": [{"HostedZoneId": "Z1", "ResourceRecordSets": [{"Name": "a.x.org.", "Type": "A", "TTL": 60, "ResourceRecords": [{"Value": "1.1.1.1"}]}, {"Name": "b.x.org.", "Type": "A", "AliasTarget": {"DNSName": "lb"}}]}],
    },
    "cloudfront": {
        "distributions": [{"DistributionList": {"Items": [{"Id": "E1", "DomainName": "d.net", "Status": "Deployed"}]}}],
        "details": [{"Distribution": {"Id": "E1", "DomainName": "d.net", "Status": "Deployed", "DistributionConfig": {"Origins": {"Items": [{"Id": "o", "DomainName": "b.s3.amazonaws.com"}]}, "Enabled": True}}, "Tags": {"Items": []}}],
    },
    "apigateway": {
        "rest_apis": [{"items": [{"id": "r1", "name": "", "createdDate": "2024-01-01T00:00:00Z"}]}],
        "apis": [{"Items": [{"ApiId": "h1", "Name": "h", "ProtocolType": "HTTP"}]}],
    },
    "transfer": {
        "servers": [{"Servers": [{"ServerId": "s-1"}]}],
        "details": [{"Server": {"ServerId": "s-1", "EndpointType": "VPC", "EndpointDetails": {"VpcId": "vpc-1", "SubnetIds": ["a"]}}}],
    },
    "rds": {
        "instances": [{"DBInstances": [{"DBInstanceIdentifier": "db", "Engine": "mysql", "DBInstanceClass": "m", "DBInstanceStatus": "available", "Endpoint": {"Address": "h", "Port": 3306}, "DBSubnetGroup": {"DBSubnetGroupName": "g"}}]}],
        "subnet_groups": [{"DBSubnetGroups": [{"DBSubnetGroupName": "g", "VpcId": "vpc-1"}]}],
    },
    "redshift": {"clusters": [{"Clusters": [{"ClusterIdentifier": "w", "Tags": [{"Key": "AppId", "Value": "1"}, {"Key": "AppId", "Value": "2"}]}]}]},
    "s3": {
        "buckets": [{"Buckets": [{"Name": "b"}]}],
        "details": [{"Bucket": "b", "TagSet": [{"Key": "Owner", "Value": "me"}], "NotificationConfiguration": {"LambdaConfigurations": [{"Id": "1"}], "TopicConfigurations": []}}],
        "metrics": [{"Bucket": "b", "StorageType": "StandardStorage", "Timestamp": "2024-01-14T00:00:00", "Maximum": 848000.0, "RunTime": "2024-01-15T12:00:00"}],
    },
    "glue": {"jobs": [{"Jobs": [{"Name": "g", "Command": {"Name": "glueetl", "ScriptLocation": "s3://x/a.py"}, "CreatedOn": "2024-01-01T00:00:00+01:00"}]}]},
    "athena": {"executions": [{"QueryExecution": {"QueryExecutionId": "12345678-9", "Query": "select * from t", "Statistics": {"TotalExecutionTimeInMillis": 1500}}}]},
    "tax": {
        "listed": [{"QueryExecutions": [{"QueryExecutionId": "q1"}, {"QueryExecutionId": "q2"}]}],
        "executions": [{"QueryExecution": {"QueryExecutionId": "q1", "Query": "select from"}}],
    },
    "cloudformation": {"stacks": [{"Stacks": [{"StackName": "st", "StackStatus": "CREATE_COMPLETE", "CreationTime": "2024-01-01T00:00:00", "Capabilities": ["B", "A"]}, {"StackName": "gone", "StackStatus": "DELETE_COMPLETE"}]}]},
    "cloudtrail_trails": {"trails": [{"trailList": [{"Name": "t", "S3BucketName": "logs"}]}]},
    "ssm": {
        "associations": [{"Associations": [{"AssociationId": "as", "Name": "n"}, {"AssociationId": "as2"}]}],
        "compliance": [{"ComplianceItems": [{"Id": "as", "Status": "COMPLIANT"}] + [{"Id": "as", "Status": "X"}] * 7}],
    },
    "stepfunctions": {
        "state_machines": [{"stateMachines": [{"stateMachineArn": "arn:x:sm", "name": "sm"}]}],
        "details": [{"stateMachineArn": "arn:x:sm", "roleArn": "arn:role/r"}],
        "versions": [{"stateMachineArn": "arn:x:sm", "stateMachineVersions": []}],
        "executions": [{"stateMachineArn": "arn:x:sm", "executions": [{"name": "a-1"}, {"name": "b-1"}]}],
    },
    "codepipeline": {
        "listed": [{"pipelines": [{"name": "p"}]}],
        "executions": [{"pipelineName": "p", "pipelineExecutionSummaries": [{"status": "Succeeded", "startTime": "2024-01-01T00:00:00Z", "sourceRevisions": [{"actionName": "src", "revisionId": "0123456789abc"}]}]}],
    },
    "codebuild": {"listed": [{"projects": ["pr"]}], "projects": [{"projects": [{"name": "pr", "source": {"type": "GITHUB"}}]}]},
    "sns": {"topics": [{"Topics": [{"TopicArn": "arn:aws:sns:r:1:t"}, {}]}]},
    "kms": {
        "keys": [{"KeyMetadata": {"KeyId": "k", "KeyManager": "CUSTOMER", "KeyState": "Enabled"}}, {"KeyMetadata": {"KeyId": "v", "KeyManager": "AWS"}}],
        "aliases": [{"KeyId": "k", "Aliases": [{"AliasName": "alias/k"}]}],
        "tags": [{"KeyId": "k", "Tags": [{"TagKey": "a", "TagValue": "b"}]}],
    },
}
DOCS["subnets"] |= {k: v for k, v in DOCS["vpc"].items() if k != "security_groups"}

EXPECTED: dict[str, list[dict]] = {
    "ec2": [
        {"instance_id": "i-1", "instance_name": "front", "vpc": "vpc-1 (main)", "os_details": "Amazon Linux", "iam_role": "A", "security_groups": ["web", "db"], "storage_volumes": ["vol-1"]},
        {"instance_id": "i-2", "instance_name": "N/A", "vpc": "N/A", "os_details": "Windows", "iam_role": "admin", "security_groups": []},
    ],
    "lambda": [{"function_name": "f", "handler": "h", "runtime": "N/A", "environment": 1, "triggers": '["s3"]', "tags": '{"team":"core"}', "vpc_config": "N/A", "role": "N/A"}],
    "eks": [{"cluster_name": "k", "support_period": "Standard - Ends Feb 25, 2026", "addons": ["coredns", "vpc-cni"], "tags": {}}],
    "ecr": [{"repository_name": "r", "domain": "111", "business_app_id": "B1", "repository_size": 0, "image_tags": ["v1"]}],
    "emr": [
        {"cluster_id": "j-1", "application_types": "Spark", "security_configuration": "Default", "state": "WAITING"},
        {"cluster_id": "j-2", "cluster_name": "N/A", "security_configuration": "N/A", "state": "UNKNOWN"},
    ],
    "vpc": [{"vpc_id": "vpc-1", "subnets": ["sn-1", "sn-2"], "availability_zones": ["b"], "vpc_peerings": [], "vpn_connections": [], "internet_gateways": ["igw-1"]}],
    "subnets": [
        {"subnet_id": "sn-1", "vpc_name": "N/A", "security_groups": "sg-1", "vpc_endpoints": "ep-1", "vpc_peerings": "pcx-1", "route_tables": "rt-1", "acls": ""},
        {"subnet_id": "sn-2", "security_groups": "", "vpc_endpoints": "", "route_tables": "", "internet_gateways": "igw-1"},
    ],
    "route53": [
        {"record_id": "Z1_a.x.org._A", "record_value": "1.1.1.1", "ttl": "60", "hosted_zone": "x.org."},
        {"record_id": "Z1_b.x.org._A", "record_value": "lb", "ttl": "N/A"},
    ],
    "cloudfront": [{"distribution_id": "E1", "origins": '[{"id":"o","domain":"b.s3.amazonaws.com","type":"S3"}]', "enabled": True, "cache_behaviors": "Default only", "price_class": "PriceClass_All"}],
    "apigateway": [
        {"api_id": "h1", "protocol": "HTTP", "created_date": None, "endpoint_type": "REGIONAL"},
        {"api_id": "r1", "name": "N/A", "protocol": "REST", "created_date": "2024-01-01 00:00:00.000000"},
    ],
    "transfer": [{"server_id": "s-1", "endpoint": "VPC: vpc-1, Subnets: 1", "domain": "S3", "state": "UNKNOWN"}],
    "rds": [{"db_instance_id": "db", "vpc": "vpc-1", "port": "3306", "storage_size": "N/A", "has_replica": False}],
    "redshift": [{"database_id": "w", "app_id": "2", "node_count": 1, "port": 0, "storage_size": "0"}],
    "s3": [{"bucket_name": "b", "bucket_name_display": "b", "owner": "me", "integrations": "Lambda", "capacity": "828.12 KB", "network_config": "Unknown", "versioning": "Disabled", "region": "us-east-1"}],
    "glue": [{"job_name": "g", "type": "ETL", "created_by": "Script", "domain": "2023-12-31 23:00:00 UTC"}],
    "athena": [{"query_id": "12345678-9", "query_name": "Query-12345678", "tables_used": "T", "execution_duration": 1.5, "owner": "primary"}],
    "tax": [
        {"query_id": "q1", "description": "select from", "tables_used": "N/A", "owner": "primary"},
        {"query_id": "q2", "description": "N/A", "tables_used": "N/A", "owner": "N/A"},
    ],
    "cloudformation": [{"stack_name": "st", "capabilities": "B, A", "description": "N/A"}],
    "cloudtrail_trails": [{"trail_name": "t", "log_location": "s3://logs/", "is_multi_region": "No", "include_global_events": "Yes"}],
    "ssm": [
        {"association_id": "as", "compliant_resources": 1, "non_compliant_resources": 7, "compliance_percentage": 12.5, "non_compliant_15_days": 2, "non_compliant_15_90_days": 2, "non_compliant_90_days": 3},
        {"association_id": "as2", "association_name": "N/A", "compliance_percentage": 0.0, "non_compliant_90_days": 0},
    ],
    "stepfunctions": [{"stepfunction_arn": "arn:x:sm", "instance_id": "sm", "triggers": 2, "versions": 0, "roles_permissions": "r"}],
    "codepipeline": [{"pipeline_name": "p", "last_execution_status": "Succeeded", "latest_source_revisions": "src:0123456789", "recent_executions": 1, "last_execution_started": "2024-01-01 00:00:00.000000"}],
    "codebuild": [{"project_name": "pr", "source_provider": "GITHUB", "repository": "N/A", "last_modified": None}],
    "sns": [{"topic_arn": "N/A", "topic_name": "N/A"}, {"topic_arn": "arn:aws:sns:r:1:t", "topic_name": "t"}],
    "kms": [{"key_id": "k", "key_name": "alias/k", "key_type": "Simétrica", "key_spec": "SYMMETRIC_DEFAULT"}],
}


def audit_event(event_id: str, name: str, source: str, time: str, request: dict | None, user: str = "ann", **more) -> dict:
    detail = {
        "eventID": event_id, "eventName": name, "eventSource": source, "eventTime": time, "awsRegion": "us-east-1",
        "userIdentity": {"userName": user}, "requestParameters": request, **more,
    }
    return {"CloudTrailEvent": json.dumps(detail)}


def land(root, run_date: str, docs: dict[str, dict[str, list[dict]]]) -> None:
    """Write documents below ``root`` in the landing layout."""
    for service, datasets in docs.items():
        for name, pages in datasets.items():
            folder = root / service / name / f"dt={run_date}"
            folder.mkdir(parents=True, exist_ok=True)
            lines = [json.dumps({**ACCOUNT, "doc": page}) for page in pages]
            (folder / "part.json").write_text("\n".join([*lines, "{broken"]) + "\n")
